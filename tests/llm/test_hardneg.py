import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnstile.llm import hardneg
from turnstile.llm.queries import op13_hard_negatives, oracle_sql

FOLDER = "/root/testdata/sf0.1"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, anchors, positives=5, negatives=10, low=30, high=90, scale=256):
    """rows: {id: (label, vector)}; whole numbers of Python only, the nearest long where one is beyond."""
    whole = {i: (label, [math.floor(scale * float(x)) for x in v]) for i, (label, v) in rows.items()}
    dot = lambda a, b: max(1 - 2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b))))
    out = set()
    for a in anchors:
        label, v = whole[a]
        scored = sorted((-dot(v, w), i, other) for i, (other, w) in whole.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            hit = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s]
            out |= {(a, p, k, n, -s, -t) for k, (t, n, _) in enumerate(hit[:negatives], 1)}
    return out


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label int, anchor boolean{extra}")


def mined(df, **options):
    got = [tuple(r[c] for c in COLUMNS) for r in hardneg.hard_negatives(df, "anchor", **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_query_equals_plain_python(spark):
    rows = {}
    for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect():
        rows[r.vec_id] = ((r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
    got = {tuple(r) for r in op13_hard_negatives(spark, FOLDER).select(COLUMNS).collect()}
    assert got == brute(rows, [i for i in rows if i % 100 == 0]) and got
    assert "op13_hard_negatives" in oracle_sql()


VECTORS = st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=2, max_size=12)


@settings(max_examples=200, deadline=None)
@given(VECTORS, st.integers(1, 4), st.sampled_from([1, 1000, 10**8]))
def test_no_score_leaves_its_bounds(vectors, count, factor):
    v = np.array(vectors, float) * factor
    unit, norms = hardneg.directions(v)
    refs = hardneg.references(unit, count)
    angles = np.arccos(np.clip(unit @ refs.T, -1, 1)).astype(np.float32).astype(float)
    rows = hardneg.Rows(np.arange(len(v)), np.zeros(len(v)), v, norms, angles)
    true = np.array([[sum(int(a) * int(b) for a, b in zip(x, y)) for y in v] for x in v], dtype=object)
    top, low = hardneg.bounds(rows, rows)
    assert (true <= top).all() and (true >= low).all()
    high, least = hardneg.chunk_bounds(rows, rows)
    assert (true.max(axis=1) <= high).all() and (true.min(axis=1) >= least).all()


def clustered(seed, groups, size, width=16, noise=0.05):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, width))
    centre /= np.linalg.norm(centre, axis=1, keepdims=True)
    rows, n = {}, 0
    for g in range(groups):
        for _ in range(size):
            rows[n] = (int(rng.integers(3)), (centre[g] + noise * rng.normal(size=width)).tolist())
            n += 1
    return rows


def test_windows_spare_most_scores_where_rows_cluster():
    """Counted: of all pairs of an anchor and a row few get a score, and none that matters is missed."""
    rows = clustered(5, 40, 256)
    v = np.floor(256 * np.array([x for _, x in rows.values()]))
    unit, norms = hardneg.directions(v)
    refs = hardneg.references(unit[:: len(unit) // 1024], 8)
    angles = np.arccos(np.clip(unit @ refs.T, -1, 1)).astype(np.float32).astype(float)
    every = hardneg.Rows(np.arange(len(v)), np.array([label for label, _ in rows.values()]), v, norms, angles)
    every = every.part(np.lexsort((angles.min(axis=1), angles.argmin(axis=1))))
    anchors = every.part(np.flatnonzero(every.ids % 100 == 0))
    best = hardneg.Best(anchors, np.full((len(anchors), 1), hardneg.LONG.min + 1), np.full((len(anchors), 1), hardneg.LONG.max), 5, True)
    for i in range(0, len(every), hardneg.CHUNK):
        best.look(every.part(slice(i, i + hardneg.CHUNK)))
    assert best.looked == len(anchors) * len(every)
    assert best.scored < best.looked / 8
    score = hardneg.scores(anchors, every)
    for k, a in enumerate(anchors.ids):
        able = [(-score[k, j], every.ids[j]) for j in range(len(every)) if every.labels[j] == anchors.labels[k] and every.ids[j] != a]
        assert [(-s, i) for s, i in zip(best.scores[k, 0], best.ids[k, 0])] == sorted(able)[:5]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3000}, {"reference_count": 1, "sample": 2}])
def test_clusters_equal_plain_python(spark, options):
    rows = clustered(1, 6, 60)
    df = frame(spark, [(i, v, label, i % 10 == 0) for i, (label, v) in rows.items()]).repartition(5)
    assert mined(df, **options) == brute(rows, range(0, len(rows), 10))


def test_one_vector_holds_a_third_and_one_label_too(spark):
    """Ties of thousands are settled by id."""
    rng = np.random.default_rng(2)
    rows = {i: (0 if i % 3 == 0 else int(rng.integers(4)), [0.5, 0.5, 0.1] if i % 3 else rng.normal(size=3).tolist()) for i in range(3000)}
    df = frame(spark, [(i, v, label, i % 500 == 0 or i == 1) for i, (label, v) in rows.items()]).repartition(7)
    assert mined(df) == brute(rows, [*range(0, 3000, 500), 1])


@pytest.mark.parametrize("big", [1e3, 1e6, 1e7, 1e14])
def test_large_components_stay_exact(spark, big):
    """In doubles, in longs beyond 2**53, in Python's numbers, and where nearly all scores are beyond a long."""
    rng = np.random.default_rng(4)
    rows = {i: (i % 2, (rng.normal(size=4) * big).tolist()) for i in range(60)}
    df = frame(spark, [(i, v, label, i % 6 == 0) for i, (label, v) in rows.items()])
    want = brute(rows, range(0, 60, 6))
    assert mined(df) == want and (want or big == 1e14)


def test_odd_rows(spark):
    """Nulls, vectors of zeros, not finite, short, empty; repeats; clashing names; few positives; none at all."""
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 0.0], 1, True), (2, [0.9, 0.1], 1, False), (3, [0.5, 0.5], 2, False), (4, [0.4], 2, None), (5, [0.0, 0.0], 1, False), (6, [], 2, True), (7, [-1.0, 0.3], 3, False)]
    bad = [(None, [1.0, 1.0], 1, True), (8, None, 1, True), (9, [1.0, None], 2, True), (10, [nan, 1.0], 2, True), (11, [1.0, inf], 2, False), (12, [1.0, 1.0], None, True)]
    rows = {i: (label, v) for i, v, label, _ in good}
    want = brute(rows, [1, 6])
    assert mined(frame(spark, [r + (0, 0.5) for r in good + bad], ", rank int, score double")) == want and want
    # A row that is repeated counts once, whichever copy asks; of other contents under its id the least counts.
    again = [*good, *good, (1, [1.0, 0.0], 1, False), (3, [0.9, 0.9], 2, False), (3, [0.1, 0.1], 9, True)]
    assert mined(frame(spark, again)) == brute(rows, [1, 3, 6])
    assert mined(frame(spark, [(1, [1.0], 1, True)])) == set()
    assert mined(frame(spark, good).where("vec_id in (1, 2)")) == set()
    assert mined(frame(spark, good).limit(0)) == set() and mined(frame(spark, good).withColumn("anchor", F.lit(None).cast("boolean"))) == set()
