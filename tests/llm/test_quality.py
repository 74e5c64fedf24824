import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnstile.llm import quality
from turnstile.llm.queries import op12_quality

FOLDER = "/root/testdata/sf0.1"


def plain_tokens(text):
    """Words and runs of signs, a repeat as None."""
    found = re.findall(r"[a-z0-9\x80-\U0010ffff]+|[\x00-\x08\x0e-\x1f!-/:-@\[-`{-\x7f]+", (text or "").lower())
    return [None if i and t == found[i - 1] else t for i, t in enumerate(found)]


def grams(text):
    t = plain_tokens(text)
    return Counter([(a,) for a in t] + list(zip(t, t[1:])))


def values(text, order=2, bits=18):
    return dict(zip(*next(quality.features(pa.array([text], pa.string()), order, bits)), strict=True))


@pytest.mark.parametrize("text", ["", None, " \n", "a", "a a a b", "Über!! das!! ... das | das", "x###y  x###y\tz", "日本 日本, é"])
def test_values_are_those_of_the_plain_n_grams(text):
    want = grams(text)
    weight = [1 + math.log(n) for n in want.values()]
    norm = math.sqrt(sum(w * w for w in weight))
    # Places are hashes; as many as there are n-grams, with the same values.
    assert sorted(values(text).values()) == pytest.approx(sorted(w / norm for w in weight))


def test_texts_do_not_touch_each_other():
    texts = ["a b", None, "b a b!!", "", "a b"] * 200
    found = list(quality.features(pa.array(texts), 2, 18))
    for text, (places, v) in zip(texts, found, strict=True):
        assert dict(zip(places, v, strict=True)) == values(text)
    assert values("one two") != values("two one")
    assert set(values("go go go")) & set(values("no no no"))  # the repeat is one token for all words


def test_updates_follow_the_formula():
    rng = np.random.default_rng(3)
    model = quality.Ftrl(np.zeros(9), np.zeros(9), 0.7, 1.0, 0.1, 0.3)
    z, n = [0.0] * 9, [0.0] * 9

    def weight(i):
        l1, l2 = (0.0, 0.0) if i == 8 else (0.1, 0.3)
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((1.0 + math.sqrt(n[i])) / 0.7 + l2)

    for _ in range(300):
        at = np.sort(rng.choice(8, 3, replace=False))
        x, label = rng.normal(size=3), int(rng.random() < 0.7)
        model.learn(at, x, label)
        row = [*zip(at.tolist(), x.tolist(), strict=True), (8, 1.0)]
        w = {i: weight(i) for i, _ in row}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in row)))
        for i, v in row:
            g = (p - label) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.7 * w[i]
            n[i] += g * g
    assert model.z.tolist() == pytest.approx(z) and model.n.tolist() == pytest.approx(n)
    assert model.weights().tolist() == pytest.approx([weight(i) for i in range(9)])


def brute(docs, labels, shards, rounds):
    """Scores by plain dictionaries over the operator's places; shards, rounds and averages as it says."""
    alpha, l1, size = 4.0, 0.02, 1 << 18
    weight = lambda s, i: 0.0 if abs(s[0]) <= (0.0 if i == size else l1) else -(s[0] - math.copysign(0.0 if i == size else l1, s[0])) / ((1 + math.sqrt(s[1])) / alpha)
    rows = {i: {**values(t), size: 1.0} for i, t in docs.items()}
    state = {}
    for _ in range(rounds):
        sums = {}
        for mine in shards:
            own = dict(state)
            for i in mine:
                x = rows[i]
                w = {k: weight(own.get(k, (0.0, 0.0)), k) for k in x}
                g = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items()))) - labels[i]
                for k, v in x.items():
                    z, n = own.get(k, (0.0, 0.0))
                    more = n + (g * v) ** 2
                    own[k] = (z + g * v - (math.sqrt(more) - math.sqrt(n)) / alpha * w[k], more)
            for k, s in own.items():
                if s != state.get(k):
                    sums.setdefault(k, []).append(s)
        state |= {k: tuple(sum(c) / len(c) for c in zip(*v, strict=True)) for k, v in sums.items()}
    return {i: 1 / (1 + math.exp(-sum(weight(state.get(k, (0.0, 0.0)), k) * v for k, v in x.items()))) for i, x in rows.items()}


def test_scores_equal_plain_python(spark):
    texts = ["good words here and there", "bad!! words!! here!!", "und so weiter", "x ### y ### z ###", "the same the same", "no no no no", "", None]
    docs = spark.createDataFrame([(i, texts[i % 8] and f"{texts[i % 8]} {i % 5}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 in (0, 2, 4, 6))) for i in range(0, 40)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.score_quality(docs, labels, ["doc_id"], shards=3, rounds=2).collect()}
    order = labels.join(docs, "doc_id").select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)).alias("s"), F.xxhash64("doc_id", F.lit(2), "text").alias("turn")).orderBy("turn").collect()
    shards = [[r.doc_id for r in order if r.s == s] for s in range(3)]
    want = brute({r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.quality for r in labels.collect()}, shards, 2)
    assert got == pytest.approx(want, abs=1e-4)  # values and weights are kept as 32-bit numbers


def test_held_out_accuracy(spark):
    out = op12_quality(spark, FOLDER)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.995
    assert np.mean([s >= 0.5 for s in good]) > 0.99 and np.mean([s < 0.5 for s in bad]) > 0.95


def test_held_out_labels_are_not_learned_from(spark, tmp_path):
    """Turning the labels of the held-out fold leaves every score as it is."""
    spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 600").write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("doc_id < 600")
    found = []
    for turned in (False, True):
        folder = f"{tmp_path}/{turned}"
        spark.read.parquet(f"{tmp_path}/documents.parquet").write.parquet(f"{folder}/documents.parquet")
        out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
        labels.withColumn("quality", F.when(out & F.lit(turned), 1 - F.col("quality")).otherwise(F.col("quality"))).write.parquet(f"{folder}/labels.parquet")
        found.append(sorted(map(tuple, op12_quality(spark, folder).collect())))
    assert found[0] == found[1]


def test_odd_rows(spark):
    """Nulls anywhere, empty and very long texts, repeats, clashing names, no labels, labels of one kind."""
    long = "word " * 1_500_000
    rows = [(1, "good one", 0), (1, "good one", 0), (2, "bad!!", 1), (3, None, 2), (None, "x", 3), (4, "", 4), (5, long, 5), (6, "!" * 3_000_000, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 1), (5, 0), (77, 1)], "doc_id long, quality int")
    out = quality.score_quality(docs, labels, ["doc_id", "score"])
    assert out.columns == ["doc_id", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id == 1}) == 1
    assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1
    one = quality.score_quality(docs, labels.where("quality = 1"), ["doc_id"]).collect()
    assert {(r.score, r.predicted) for r in one} == {(1.0, 1)}
    assert {(r.score, r.predicted) for r in quality.score_quality(docs, labels.limit(0), ["doc_id"]).collect()} == {(0.0, 0)}
    assert quality.score_quality(docs.limit(0), labels, ["doc_id"]).collect() == []
