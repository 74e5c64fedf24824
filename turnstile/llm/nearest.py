"""Approximate nearest neighbours by cross-polytope hashing.

A vector is turned by a fast pseudo-rotation (three times: random signs, then a
Hadamard transform) and falls to its nearest signed axis, one bucket in each of
several tables. A query probes the axes nearest to its own turned vector, in all
tables; what lies there is ranked by the exact inner product. How many axes to
probe is fitted to a wanted recall on a small sample of queries with known
answers.

Buckets are joined to queries in blocks of bounded size on both sides, so that
neither a large bucket nor many queries of one bucket meet in one task.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.shared import scratch, stored

#: Rows of a bucket, and queries of a bucket, in one task.
INDEX_BLOCK, QUERY_BLOCK = 8_192, 2_048
#: Queries whose scores are held at once.
ASKED = 128


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    width, step = rows.shape[1], 1
    while step < width:
        pairs = rows.reshape(len(rows), width // (2 * step), 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), width)
        step *= 2
    return rows / np.sqrt(width)


def turned(vectors: np.ndarray, table: int, seed: int) -> np.ndarray:
    """The table's pseudo-rotation of unit vectors, padded to a power of two."""
    width = 1 << max(0, vectors.shape[1] - 1).bit_length()
    rows = np.zeros((len(vectors), width))
    rows[:, : vectors.shape[1]] = vectors
    signs = np.random.default_rng([seed, table])
    for _ in range(3):
        rows = hadamard(rows * signs.choice([-1.0, 1.0], width))
    return rows


def buckets(vectors: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Twice the nearest axis, plus one on its positive side."""
    rows = turned(vectors, table, seed)
    axis = np.abs(rows).argmax(axis=1)
    return 2 * axis + (rows[np.arange(len(rows)), axis] > 0)


def probes(vectors: np.ndarray, table: int, seed: int) -> np.ndarray:
    """All buckets, nearest first, for each vector."""
    rows = turned(vectors, table, seed)
    level = np.stack([-rows, rows], axis=2).reshape(len(rows), -1)
    return np.argsort(-level, axis=1, kind="stable")


def _unit(column) -> np.ndarray:
    rows = np.array([np.asarray(v, float) for v in column])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # far from overflow and underflow
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _best(query_keys: np.ndarray, scores: np.ndarray, keys: np.ndarray, firsts: np.ndarray, k: int) -> pd.DataFrame:
    """For each query its k nearest distinct vectors, ties to the smallest id in them."""
    whom, what, level = [], [], []
    for q, row in zip(query_keys, scores, strict=True):
        if len(row) > k:
            at = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
        else:
            at = np.arange(len(row))
        at = at[np.lexsort((firsts[at], -row[at]))][:k]
        whom.append(np.full(len(at), q))
        what.append(keys[at])
        level.append(row[at])
    none = [np.zeros(0, np.int64)]
    return pd.DataFrame({"query": np.concatenate(whom or none), "key": np.concatenate(what or none), "score": np.concatenate(level or none).astype(float)})


def search(
    vectors: DataFrame,
    is_query: str,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    tables: int = 4,
    recall: float = 0.95,
    sample: int = 128,
    seed: int = 29,
) -> DataFrame:
    """The k nearest of all other rows found for each row where the column
    ``is_query`` holds: query_id, rank from 1, vec_id, score (exact inner product).

    Vectors that are null, empty, all zero, or hold null or non-finite parts take
    no part. Shorter vectors count as filled up with zeros. Equal vectors are
    searched once and stand for all their ids; the k+1 smallest ids of a vector
    are enough for any answer. Ties go to the smaller id. Rows that repeat an id count as
    one, of the least vector; a null id takes no part. Nearest is meant among vectors of about equal length,
    since buckets see directions only. ``sample``: queries that fit the number of
    probes to ``recall``. Other columns are not read.
    """
    spark = vectors.sparkSession
    parts = F.transform(F.col(embedding), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    clean = vectors.select(F.col(vec_id).alias("id"), F.coalesce(F.col(is_query), F.lit(False)).alias("asks"), parts.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
    with scratch(spark) as kept:
        clean = kept.stored(clean.withColumn("key", F.xxhash64("v")), "vectors")
        width = clean.agg(F.max(F.size("v")).alias("w")).first()["w"]
        empty = spark.createDataFrame([], f"query_id {clean.schema['id'].dataType.simpleString()}, rank int, vec_id {clean.schema['id'].dataType.simpleString()}, score double")
        if not width:
            return empty
        repeated = kept.stored(clean.groupBy("id").count().where("count > 1").select("id"), "repeated-ids")
        if repeated.limit(1).count():
            once = clean.join(repeated, "id", "left_semi").groupBy("id").agg(F.max("asks").alias("asks"), F.min("v").alias("v"))
            clean = kept.stored(clean.join(repeated, "id", "left_anti").select("id", "asks", "v").unionByName(once).withColumn("key", F.xxhash64("v")), "single-vectors")
        if not clean.where(F.size("v") != width).isEmpty():
            full = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))
            clean = kept.stored(clean.select("id", "asks", full.alias("v")).withColumn("key", F.xxhash64("v")), "filled-vectors")
        # One row a distinct vector. Of its ids only the k+1 smallest can be in an
        # answer, which each task cuts to before the ids meet.
        ranked = clean.select("key", "id").withColumn("r", F.row_number().over(Window.partitionBy("key", F.pmod(F.xxhash64("id"), F.lit(32))).orderBy("id"))).where(F.col("r") <= k + 1)
        ids = ranked.groupBy("key").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids"))
        ask = clean.groupBy("key").agg(F.max("asks").alias("asks"), F.first("v").alias("v"))
        rows = kept.stored(ask.join(ids, "key").withColumn("first", F.col("ids")[0]), "distinct-vectors")
        asking = rows.where("asks")
        few = asking.orderBy(F.xxhash64(F.col("key"), F.lit(seed))).limit(sample).select("key", "v").collect()
        if not few:
            return empty
        asked = np.array([r["v"] for r in few])
        asked_keys = np.array([r["key"] for r in few])
        shared = spark.sparkContext.broadcast((asked, asked_keys))

        def answer(frames):
            queries, keys = shared.value
            for f in frames:
                if len(f):
                    scores = queries @ np.array(f["v"].tolist()).T
                    scores[keys[:, None] == f["key"].to_numpy()[None, :]] = -np.inf
                    yield _best(keys, scores, f["key"].to_numpy(), f["first"].to_numpy(), k)

        # At most k rows a sample query and batch, then k rows a sample query.
        top = Window.partitionBy("query").orderBy(F.desc("score"), "key")
        near = rows.select("key", "v", "first").mapInPandas(answer, "query long, key long, score double").withColumn("r", F.row_number().over(top)).where((F.col("r") <= k) & (F.col("score") > float("-inf")))
        truth = near.join(rows.select("key", "v"), "key").select("query", "v").collect()
        place = {q: i for i, q in enumerate(asked_keys.tolist())}
        best = np.full(len(truth), 1 << 30)
        if truth:
            whom = np.array([place[r["query"]] for r in truth])
            hit = _unit([r["v"] for r in truth])
            for t in range(tables):
                order = probes(_unit(asked), t, seed).argsort(axis=1)
                best = np.minimum(best, order[whom, buckets(hit, t, seed)])
        depth = int(np.sort(best)[int(np.ceil(recall * len(best))) - 1]) + 1 if truth else 1

        def indexed(frames):
            for f in frames:
                unit = _unit(f["v"]) if len(f) else None
                for t in range(tables if len(f) else 0):
                    yield pd.DataFrame({"table": t, "bucket": buckets(unit, t, seed), "key": f["key"], "first": f["first"], "v": f["v"]})

        def probing(frames):
            for f in frames:
                unit = _unit(f["v"]) if len(f) else None
                for t in range(tables if len(f) else 0):
                    near = probes(unit, t, seed)[:, :depth]
                    n = near.shape[1]
                    yield pd.DataFrame({"table": t, "bucket": near.ravel(), "key": np.repeat(f["key"].to_numpy(), n), "v": [v for v in f["v"] for _ in range(n)]})

        index = kept.stored(rows.select("key", "v", "first").mapInPandas(indexed, "table int, bucket int, key long, first long, v array<double>"), "index")
        asks = kept.stored(asking.select("key", "v").mapInPandas(probing, "table int, bucket int, key long, v array<double>"), "probes")
        # Buckets are few (two for each axis and table): their sizes fit one broadcast.
        size = lambda df, block, name: df.groupBy("table", "bucket").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
        blocks = F.broadcast(size(index, INDEX_BLOCK, "i_n").join(size(asks, QUERY_BLOCK, "q_n"), ["table", "bucket"]))
        spread = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = index.join(blocks, ["table", "bucket"]).select("table", "bucket", spread("i_n").alias("i"), every("q_n").alias("q"), "key", "first", "v")
        right = asks.join(blocks, ["table", "bucket"]).select("table", "bucket", every("i_n").alias("i"), spread("q_n").alias("q"), "key", "v")

        def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"query": [], "key": [], "score": []})
            asked, held = np.array(b["v"].tolist()), np.array(a["v"].tolist()).T
            keys, firsts, whom = a["key"].to_numpy(), a["first"].to_numpy(), b["key"].to_numpy()
            # A few queries at a time: their scores are a table as wide as the block.
            # The query's own vector stays: other ids may share it.
            return pd.concat([_best(whom[i : i + ASKED], asked[i : i + ASKED] @ held, keys, firsts, k + 1) for i in range(0, len(whom), ASKED)])

        at = ["table", "bucket", "i", "q"]
        met = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(meet, "query long, key long, score double")
        own = asking.select(F.col("key").alias("query"), F.col("key"), F.lit(None).cast("double").alias("score"))
        found = met.unionByName(own).groupBy("query", "key").agg(F.max("score").alias("score"))
        answers = found.join(rows.select("key", "ids", F.col("v").alias("theirs")), "key").join(rows.select(F.col("key").alias("query"), "v"), "query")
        dot = F.aggregate(F.zip_with("v", "theirs", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        top = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
        # k+1 vectors hold k other ids for any of the query's rows.
        short = answers.select("query", "ids", F.coalesce("score", dot).alias("score")).withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1)
        flat = short.select("query", "score", F.explode("ids").alias("vec_id"))
        lists = flat.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
        lists = lists.groupBy("query").agg(F.array_sort(F.collect_list(F.struct(F.col("r"), "vec_id", "score"))).alias("list"))
        who = clean.where("asks").select(F.col("id").alias("query_id"), F.col("key").alias("query"))
        listed = who.join(lists, "query").select("query_id", F.posexplode(F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("rank", "hit"))
        return stored(listed.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")), "neighbours")
