"""Quality by logistic regression over hashed word n-grams, learned with
follow-the-regularised-leader (FTRL-proximal) updates.

A text's tokens are its words and its runs of signs, so that what hangs on a word
is seen apart from it; a token that repeats the one before it is a token of its
own. Tokens and pairs of neighbours are hashed to places of one weight vector, and
a score is a sparse dot product with it.

Learning is split: the sample is dealt to a fixed number of shards, each learns
on from the common state, and the states are averaged place by place, over the
shards that met the place, before the next round. One shard's rows are bounded by
the sample's bound.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.shared import SIGNS, SPACES, batch, parts, scratch, token_hashes

#: Kinds of bytes: white space, letters and digits, other signs.
_KINDS = np.where(SPACES, 0, np.where(SIGNS, 2, 1)).astype(np.int8)
#: Stands for a token equal to the one before it.
_AGAIN = np.uint64(0xA24BAED4963EE407)
_MIX = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xBF58476D1CE4E5B9))
#: Tokens whose n-grams are counted in one go.
_BLOCK = 1 << 18

_STATE = "place int, z double, n double"
_ROWS = pa.schema([("places", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])


def ngrams(tokens: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Places of all n-grams of up to ``order`` tokens."""
    if not len(tokens):
        return np.zeros(0, np.int64)
    tokens = np.where(np.concatenate([[False], tokens[1:] == tokens[:-1]]), _AGAIN, tokens)
    found, held = [], np.zeros(len(tokens), np.uint64)
    for k in range(min(order, len(tokens))):
        held = (held[: len(tokens) - k] ^ tokens[k:]) * _MIX[0]
        held ^= held >> np.uint64(32)
        found.append((held * _MIX[1]) >> np.uint64(64 - bits))
    return np.concatenate(found).astype(np.int64)


def features(column: pa.Array, order: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its places, ascending, and their values: 1 + log of the count,
    at unit length. A text without tokens has none."""

    def counted(block: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        # Text number and place as one number, so that one sort serves all texts.
        keys = [(np.int64(i) << bits) | p for i, p in enumerate(block)]
        keys, counts = np.unique(np.concatenate(keys), return_counts=True)
        values = 1 + np.log(counts)
        ends = np.searchsorted(keys >> bits, np.arange(len(block) + 1))
        for i in range(len(block)):
            v = values[ends[i] : ends[i + 1]]
            yield keys[ends[i] : ends[i + 1]] & ((1 << bits) - 1), v / max(np.sqrt(v @ v), 1e-300)

    block, size = [], 0
    for tokens in token_hashes(column, _KINDS):
        block.append(ngrams(tokens, order, bits))
        size += len(tokens)
        if size >= _BLOCK:
            yield from counted(block)
            block, size = [], 0
    if block:
        yield from counted(block)


class Ftrl:
    """FTRL-proximal state: per place the sum ``z`` and the squared gradients ``n``.
    The last place is the constant term, which nothing holds back."""

    def __init__(self, z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = z, n
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Of the places ``at``, of which the constant term must be the last."""
        z, n = self.z[at], self.n[at]
        held = np.ones(len(z))
        held[-1] = 0.0
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2 * held
        l1 = self.l1 * held
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / rate)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        """One update; the constant term goes with every row."""
        at = np.append(places, len(self.z) - 1)
        x = np.append(values, 1.0)
        w = self.weights(at)
        g = (logistic(w @ x) - label) * x
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more


def logistic(level: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(level, -35.0, 35.0)))


def _round(rows: DataFrame, state: tuple[np.ndarray, np.ndarray], settings: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The common state after every shard has learned on from it and their states
    were averaged."""
    shared = rows.sparkSession.sparkContext.broadcast(state)

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        z, n = (a.copy() for a in shared.value)
        model = Ftrl(z, n, *settings)
        # An order of its own, the same in every run; equal rows are alike.
        for r in frame.sort_values(["turn", "label"], kind="stable").itertuples():
            model.learn(np.asarray(r.places, np.int64), np.asarray(r.values, float), r.label)
        met = np.flatnonzero(model.n != shared.value[1])
        return pd.DataFrame({"place": met.astype(np.int32), "z": z[met], "n": n[met]})

    # As many rows as places at most, whatever the number of documents.
    means = rows.groupBy("shard").applyInPandas(learn, _STATE).groupBy("place").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toArrow()
    shared.unpersist()
    z, n = (a.copy() for a in state)
    at = means.column("place").to_numpy()
    z[at], n[at] = means.column("z").to_numpy(), means.column("n").to_numpy()
    return z, n


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    keep: list[str],
    text: str = "text",
    label: str = "quality",
    doc_id: str = "doc_id",
    sample_rows: int = 20_000,
    order: int = 2,
    bits: int = 18,
    shards: int = 8,
    rounds: int = 4,
    alpha: float = 4.0,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.0,
) -> DataFrame:
    """The columns ``keep`` of each row of ``docs``, with score (0 to 1) and predicted.

    ``labels``: ids and 0/1 labels of the rows of ``docs`` to learn from; about
    ``sample_rows`` of them are used, picked by a hash of the id, or all if there
    are fewer. Null ids and labels are left out. All of a text is read, in learning
    and in scoring. A text without tokens, null or empty, is scored on the constant
    term alone. With labels of one kind only, that kind's share is every score, 0
    without any. Equal texts score alike, and all rows return. A column of ``keep``
    named score or predicted gives way to the new one.

    order, bits      longest n-gram; the weight vector has 2**bits places
    shards, rounds   of the learning; the result does not depend on the cluster
    alpha, beta, l1, l2   of FTRL-proximal, at the default of no smoothing
    """
    spark = docs.sparkSession
    kept_names = [c for c in keep if c.lower() not in ("score", "predicted")]
    chosen = labels.select(F.col(f"`{doc_id}`").alias("id"), (F.col(f"`{label}`") > 0).cast("int").alias("label")).dropna()
    n, scale = chosen.count(), 1_000_000
    if n > sample_rows:
        chosen = chosen.where(F.pmod(F.xxhash64("id"), F.lit(scale)) < int(scale * sample_rows / n))

    def hashed(batches):
        for b in parts(batches):
            found = list(features(b.column("text"), order, bits))
            made = batch(_ROWS, [p for p, _ in found], [v for _, v in found])
            yield pa.record_batch([b.column("label"), b.column("shard"), b.column("turn"), *made.columns], names=["label", "shard", "turn", *_ROWS.names])

    known = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    settings = (alpha, beta, l1, l2)
    state = (np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1))
    share = None
    with scratch(spark) as kept:
        sample = known.join(F.broadcast(chosen), "id").select(
            "label", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), F.xxhash64("id", F.lit(2), "text").alias("turn"), "text"
        )
        rows = kept.stored(sample.mapInArrow(hashed, "label int, shard int, turn long, places array<int>, values array<float>"), "quality-sample")
        kinds = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("good")).first()
        if kinds["good"] in (0, kinds["n"]):
            share = kinds["good"] / kinds["n"] if kinds["n"] else 0.0
        else:
            for _ in range(rounds):
                state = _round(rows, state, settings)
    if share is not None:
        score = F.lit(float(share))
        return docs.select(*(F.col(f"`{c}`") for c in kept_names), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
    weights = spark.sparkContext.broadcast(Ftrl(*state, *settings).weights().astype(np.float32))
    names = [f"c{i}" for i in range(len(kept_names))]
    source = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(kept_names, names, strict=True)), F.col(f"`{text}`").cast("string").alias("__text"))

    def scored(batches):
        w = weights.value
        for b in parts(batches):
            level = np.array([w[p] @ v for p, v in features(b.column("__text"), order, bits)]) + w[-1]
            score = logistic(level.astype(float))
            yield pa.record_batch([*(b.column(c) for c in names), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[*names, "score", "predicted"])

    out = source.select(*names, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    return source.mapInArrow(scored, out).toDF(*kept_names, "score", "predicted")
