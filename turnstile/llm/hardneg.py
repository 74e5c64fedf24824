"""Hard negatives by angular triangle filtering.

Every row stores its angles to a few reference directions. For an anchor and a row
these give, by the triangle inequality on the sphere, an interval of the angle
between them; its cosines times both norms, rounded outward, bound their score.
Integer scores are only worked out where that interval meets a window which still
takes rows. Rows are stored in the order of their nearest reference and of the
angle to it, so that one look at the extremes of a chunk of rows spares an anchor
the whole chunk.

Anchors are taken block by block: each block is small enough to be sent to all
tasks, and every task holds no more than the best rows of a block's windows. No
row is moved or copied for an anchor, whatever its label.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.shared import scratch
from turnstile.session import scratch_dir

#: Rows whose extremes are looked at together, and anchors bounded row by row at once.
CHUNK, GROUP = 512, 64
#: Stored angles are 32-bit numbers; their error and that of the arc cosine, on both sides.
SLACK = 4e-6
#: Scores of no row.
NONE = np.iinfo(np.int64).min
LONG = np.iinfo(np.int64)


def references(unit: np.ndarray, count: int) -> np.ndarray:
    """Directions far from each other: each next one is the row whose nearest
    chosen one is farthest. Fewer if the rows have fewer directions."""
    chosen = [0] if len(unit) else []
    nearest = unit @ unit[0] if chosen else np.zeros(0)
    while chosen and len(chosen) < count:
        at = int(nearest.argmin())
        if nearest[at] > 1 - 1e-9:
            break
        chosen.append(at)
        nearest = np.maximum(nearest, unit @ unit[at])
    return unit[chosen]


def matrix(rows: Iterable, width: int, kind=np.float64) -> np.ndarray:
    """Vectors as rows, short ones filled up with zeros."""
    rows = list(rows)
    out = np.zeros((len(rows), width), kind)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and norms; a vector of zeros stays."""
    norms = np.linalg.norm(vectors, axis=1)
    return vectors / np.where(norms > 0, norms, 1.0)[:, None], norms


@dataclass
class Rows:
    """Some rows with all that bounds their scores."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, at) -> "Rows":
        return Rows(self.ids[at], self.labels[at], self.vectors[at], self.norms[at], self.angles[at])


def _above(cosine: np.ndarray, size: np.ndarray) -> np.ndarray:
    """More than any rounding could add."""
    return np.ceil(cosine * size + size * 1e-9) + 1


def _below(cosine: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.floor(cosine * size - size * 1e-9) - 1


def bounds(anchors: Rows, rows: Rows, lower: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """No score of an anchor and a row is above the first, or below the second, table.

    With the angles s and t of both to a reference, the angle between them lies
    from |s - t| to s + t (or what is left of a full turn), and the cosines of these are
    cos s cos t + sin s sin t and cos s cos t - sin s sin t.
    """
    top = np.full((len(anchors), len(rows)), 1.0)
    low = np.full_like(top, -1.0) if lower else None
    c, s = np.cos(anchors.angles), np.sin(anchors.angles)
    d, t = np.cos(rows.angles), np.sin(rows.angles)
    for r in range(anchors.angles.shape[1]):
        straight, across = np.multiply.outer(c[:, r], d[:, r]), np.multiply.outer(s[:, r], t[:, r])
        np.minimum(top, straight + across + SLACK, out=top)
        if lower:
            np.maximum(low, straight - across - SLACK, out=low)
    size = np.multiply.outer(anchors.norms, rows.norms)
    return _above(top, size), _below(low, size) if lower else None


def chunk_bounds(anchors: Rows, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """The same for each anchor and all of the rows, from the extremes of their angles and norms."""
    first, last = rows.angles.min(axis=0), rows.angles.max(axis=0)
    near = np.maximum(first - anchors.angles, anchors.angles - last).max(axis=1, initial=0.0) - SLACK
    far = np.minimum(anchors.angles + last, 2 * np.pi - anchors.angles - first).min(axis=1, initial=np.pi) + SLACK
    top, low = np.cos(np.maximum(near, 0.0)), np.cos(np.minimum(far, np.pi))
    long, short = anchors.norms * rows.norms.max(), anchors.norms * rows.norms.min()
    return _above(top, np.where(top > 0, long, short)), _below(low, np.where(low > 0, short, long))


def scores(anchors: Rows, rows: Rows) -> np.ndarray:
    """Exact inner products. Beyond a long they are the nearest long."""
    found = anchors.vectors @ rows.vectors.T
    return np.clip(found, LONG.min + 1, LONG.max).astype(np.int64) if found.dtype == object else found.astype(np.int64)


class Best:
    """The first rows of each window of each anchor, by score and then id.

    ``low`` and ``high``: the windows, one column each. ``same``: whether rows of the
    anchor's own label are meant, or those of others.
    """

    def __init__(self, anchors: Rows, low: np.ndarray, high: np.ndarray, count: int, same: bool):
        self.anchors, self.low, self.high, self.count, self.same = anchors, low, high, count, same
        self.scores = np.full((*low.shape, count), NONE)
        self.ids = np.full((*low.shape, count), LONG.max)
        self.open = low <= high
        self.looked = self.scored = 0

    def need(self, at=slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """What a score must reach, and must not pass, to be of use in any window."""
        least = np.maximum(self.low[at], self.scores[at][:, :, -1]).astype(float)
        # The greatest long stands for all that is beyond it, which bounds may show.
        most = np.where(self.high[at] == LONG.max, np.inf, self.high[at])
        return np.where(self.open[at], least, np.inf).min(axis=1, initial=np.inf), np.where(self.open[at], most, -np.inf).max(axis=1, initial=-np.inf)

    def look(self, rows: Rows) -> None:
        top, low = chunk_bounds(self.anchors, rows)
        least, most = self.need()
        self.looked += len(self.anchors) * len(rows)
        at = np.flatnonzero((top >= least) & (low <= most))
        for i in range(0, len(at), GROUP):
            self._look(at[i : i + GROUP], rows)

    def _look(self, at: np.ndarray, rows: Rows) -> None:
        anchors = self.anchors.part(at)
        least, most = (x[:, None] for x in self.need(at))
        bounded = bool((self.high < LONG.max).any())
        top, low = bounds(anchors, rows, bounded)
        wanted = ((anchors.labels[:, None] == rows.labels) == self.same) & (top >= least)
        if bounded:
            wanted &= low <= most
        if self.same:
            wanted &= anchors.ids[:, None] != rows.ids
        n = int(wanted.sum())
        self.scored += n
        # Few pairs are scored one by one, many as one product.
        every = scores(anchors, rows) if n * 8 >= wanted.size else None
        for i in np.flatnonzero(wanted.any(axis=1)):
            here = np.flatnonzero(wanted[i])
            found = scores(anchors.part([i]), rows.part(here))[0] if every is None else every[i, here]
            useful = found.astype(float) >= least[i]
            if useful.any():
                self._keep(at[i], found[useful], rows.ids[here[useful]])

    def _keep(self, anchor: int, found: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, -found))
        found, ids = found[order], ids[order]
        for w in np.flatnonzero(self.open[anchor]):
            first = np.searchsorted(-found, -self.high[anchor, w])
            stop = min(first + self.count, np.searchsorted(-found, -self.low[anchor, w], "right"))
            if first >= stop or found[first] < self.scores[anchor, w, -1]:
                continue
            s, i = np.append(self.scores[anchor, w], found[first:stop]), np.append(self.ids[anchor, w], ids[first:stop])
            # -NONE would wrap around; no score is that small.
            best = np.lexsort((i, -np.maximum(s, NONE + 1)))[: self.count]
            self.scores[anchor, w], self.ids[anchor, w] = s[best], i[best]

    def found(self) -> pd.DataFrame:
        anchor, window, place = np.nonzero(self.scores > NONE)
        return pd.DataFrame(
            {"anchor": self.anchors.ids[anchor], "pick": window.astype(np.int32), "id": self.ids[anchor, window, place], "score": self.scores[anchor, window, place]}
        )


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    """A list column as a matrix; without a loop where all lists are of full width."""
    flat, full = column.flatten(), len(column) * width
    if len(flat) == full and (column.value_lengths().to_numpy(zero_copy_only=False) == width).all():
        return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)
    return matrix(column.to_pylist(), width, kind)


@dataclass(frozen=True)
class Reader:
    """Makes ``Rows`` of a batch of the stored table."""

    width: int
    kind: type

    def __call__(self, b: pa.RecordBatch) -> Rows:
        angles = b.column("angles").flatten().to_numpy(zero_copy_only=False).astype(float)
        plain = lambda name: b.column(name).to_numpy(zero_copy_only=False)
        return Rows(plain("id"), plain("label"), _matrix(b.column("v"), self.width, self.kind), plain("norm"), angles.reshape(b.num_rows, -1))


#: What a ``Reader`` needs.
_READ = ("id", "label", "v", "norm", "angles")


def _collected(df: DataFrame, reader: Reader) -> Rows:
    """A bounded part of the table, in order of the ids."""
    found = df.select(*_READ).toArrow().combine_chunks().to_batches()
    rows = reader(found[0])
    return rows.part(np.argsort(rows.ids))


def _best(table: DataFrame, reader: Reader, anchors: Rows, low: np.ndarray, high: np.ndarray, count: int, same: bool) -> DataFrame:
    """(anchor, pick, id, score, place): the first ``count`` rows of each window."""
    sent = table.sparkSession.sparkContext.broadcast((anchors, low, high))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(*sent.value, count, same)
        for b in batches:
            rows = reader(b)
            for i in range(0, len(rows), CHUNK):
                best.look(rows.part(slice(i, i + CHUNK)))
        yield pa.RecordBatch.from_pandas(best.found(), preserve_index=False)

    found = table.select(*_READ).mapInArrow(run, "anchor long, pick int, id long, score long")
    order = Window.partitionBy("anchor", "pick").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)


def _clean(vectors: DataFrame, is_anchor: str, vec_id: str, embedding: str, label: str, scale: int) -> DataFrame:
    """(id, label, asks, v) of the rows that take part, one for each id."""
    parts = F.transform(F.col(f"`{embedding}`"), lambda x: x.cast("double"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").alias("label"), F.coalesce(F.col(f"`{is_anchor}`"), F.lit(False)).alias("asks"), parts.alias("x"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & fine)
    # A component beyond a long becomes the nearest one.
    rows = rows.select("id", "label", "asks", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))
    repeated = rows.groupBy("id").count().where("count > 1").select("id")
    if repeated.limit(1).count():
        once = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"), F.max("asks").alias("asks"))
        rows = rows.join(repeated, "id", "left_anti").unionByName(once.select("id", "r.label", "asks", "r.v"))
    return rows


def hard_negatives(
    vectors: DataFrame,
    is_anchor: str,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    reference_count: int = 8,
    sample: int = 1024,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """For each anchor, a row where the column ``is_anchor`` holds, and each of its
    positives, the hard negatives: anchor_id, positive_id, rank int from 1,
    negative_id, positive_score, negative_score.

    Components become floor(``scale`` times x); a score is the inner product of these
    whole numbers. Higher scores come first, ties by smaller id. Positives are an
    anchor's first ``positives`` other rows of its label; negatives the first
    ``negatives`` rows of another label whose score is from ``low`` to ``high`` per cent
    of the positive's, so none where that is below zero.

    Rows with a null id, label or vector, or a component that is null or not finite,
    take no part. Shorter vectors, and empty ones, count as filled up with zeros. Rows
    that repeat an id count as one, the least by label and vector, an anchor if one of
    them is. Scores beyond a long are the nearest long. Every tie is settled by id, so
    the result is the same for any layout of the data. Other columns are not read.

    ``sample``: rows the reference directions are picked from; they change the work,
    never the result. ``block_bytes``: size of a block of anchors.
    """
    spark = vectors.sparkSession
    rows = _clean(vectors, is_anchor, vec_id, embedding, label, scale)
    largest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    facts = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("anchors"), F.max(F.size("v")).alias("width"), F.max(largest).alias("largest")).first()
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not facts["anchors"]:
        return spark.createDataFrame([], empty)
    width, size = max(1, facts["width"]), facts["largest"] or 0.0
    # Doubles hold whole numbers below 2**53 exactly, and no sum here gets there.
    highest = size * size * width
    reader = Reader(width, np.float64 if highest < 2**53 else np.int64 if highest < 2**62 else object)

    few = rows.orderBy(F.xxhash64("id")).limit(sample).select("v").collect()
    chosen = references(directions(matrix([r["v"] for r in few], width))[0], reference_count)
    sent = spark.sparkContext.broadcast(chosen)
    out = f"id long, label {rows.schema['label'].dataType.simpleString()}, asks boolean, v array<{'int' if size < 2**31 else 'bigint'}>, norm double, angles array<float>, cell int, near float"

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit, norms = directions(_matrix(b.column("v"), width, np.float64))
            angles = np.arccos(np.clip(unit @ sent.value.T, -1.0, 1.0)).astype(np.float32)
            columns = [norms, list(angles), angles.argmin(axis=1).astype(np.int32), angles.min(axis=1)]
            yield pa.record_batch([*b.columns, *map(pa.array, columns)], names=[*b.schema.names, "norm", "angles", "cell", "near"])

    made = rows.withColumn("v", F.col("v").cast("array<int>") if size < 2**31 else F.col("v")).mapInArrow(measured, out)
    tasks = max(spark.sparkContext.defaultParallelism, int(facts["n"] * width * 8 // (64 << 20)))
    path = scratch_dir(spark, "hard-negatives")
    with scratch(spark) as kept:
        table = kept.stored(made.repartitionByRange(tasks, "cell", "near", "id").sortWithinPartitions("cell", "near"), "angles")
        blocks = -(-facts["anchors"] * (8 * width + 12 * reference_count + 24 * positives * negatives) // block_bytes)
        for k in range(blocks):
            mine = table.where("asks").where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)) == k)
            if blocks > 1 and mine.limit(1).count() == 0:
                continue
            anchors = _collected(mine, reader)
            every = (np.full((len(anchors), 1), LONG.min + 1), np.full((len(anchors), 1), LONG.max))
            # At most ``positives`` rows for an anchor of the block.
            first = _best(table, reader, anchors, *every, positives, True).collect()
            place = {a: i for i, a in enumerate(anchors.ids.tolist())}
            least, most = np.ones((len(anchors), positives), np.int64), np.zeros((len(anchors), positives), np.int64)
            for r in first:
                at = place[r["anchor"]], r["place"] - 1
                least[at], most[at] = -(-low * r["score"] // 100), high * r["score"] // 100
            pairs = spark.createDataFrame([(r["anchor"], r["place"] - 1, r["id"], r["score"]) for r in first], "anchor long, pick int, positive_id long, positive_score long")
            found = _best(table, reader, anchors, least, most, negatives, False).join(F.broadcast(pairs), ["anchor", "pick"])
            found.select(
                F.col("anchor").alias("anchor_id"), "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            ).write.mode("append").parquet(path)
    return spark.read.schema(empty).parquet(path)
