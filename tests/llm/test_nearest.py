import numpy as np
import pytest

from turnstile.llm import nearest
from turnstile.llm.queries import op6_nearest_neighbours


def brute(rows, k):
    """(query, neighbour) -> score of the k nearest, for ids divisible by 20."""
    ids = np.array([i for i, _ in rows])
    vectors = np.array([np.asarray(v, float) for _, v in rows])
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[q]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_recall_on_the_small_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    truth, got = brute(rows, 20), {}
    for r in op6_nearest_neighbours(spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert got.keys() == truth.keys()
    exact = {i: np.asarray(v, float) for i, v in rows}
    hits = 0
    for q, own in got.items():
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert all(s == pytest.approx(exact[q] @ exact[v], abs=1e-12) for _, v, s in own)
        assert [s for _, _, s in own] == sorted((s for _, _, s in own), reverse=True)
        hits += len({v for _, v, _ in own} & {v for v, _ in truth[q]})
    assert hits >= 0.9 * 20 * len(truth)


def test_copies_ties_and_vectors_that_take_no_part(spark):
    e = np.eye(4)
    rows = [(20, e[0]), (1, e[0]), (2, e[0]), (40, e[0]), (3, e[0] * 0.5 + e[1] * 0.1), (4, -e[0]), (5, e[2]), (9, [1.0, 2.0])]  # a short one counts as filled up
    odd = [(100, None), (6, [0.0] * 4), (7, [float("nan"), 1.0, 0, 0]), (8, [None, 1.0, 0.0, 0.0]), (10, []), (None, [1.0, 0, 0, 0]), (11, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in rows + odd], "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in nearest.search(df.selectExpr("*", "vec_id % 20 = 0 AS asks"), "asks", k=4, recall=1.0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], round(r["score"], 6))
    assert got.keys() == {20, 40}
    assert [got[20][k] for k in (1, 2, 3, 4)] == [(1, 1.0), (2, 1.0), (9, 1.0), (40, 1.0)]
    assert [got[40][k] for k in (1, 2, 3, 4)] == [(1, 1.0), (2, 1.0), (9, 1.0), (20, 1.0)]


def test_fewer_rows_than_asked_for_and_none(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (21, [0.0, 1.0])], "vec_id long, embedding array<double>").selectExpr("*", "vec_id = 20 AS asks")
    assert [(r["query_id"], r["vec_id"]) for r in nearest.search(df, "asks", recall=1.0).collect()] == [(20, 21)]
    assert nearest.search(df.limit(0), "asks").count() == 0


def test_the_rotation_keeps_lengths_and_angles():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20, 64))
    y = nearest.turned(x, 2, 3)
    assert np.allclose(x @ x.T, y @ y.T)
    assert nearest.turned(rng.normal(size=(3, 50)), 0, 3).shape == (3, 64)


def test_near_vectors_share_buckets_more_often():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 64))
    near, far = x + 0.2 * rng.normal(size=x.shape), rng.normal(size=x.shape)
    same = lambda y: (nearest.buckets(x, 0, 1) == nearest.buckets(y, 0, 1)).mean()
    assert same(near) > 0.5 > 0.05 > same(far)
    assert (nearest.probes(x, 0, 1)[:, 0] == nearest.buckets(x, 0, 1)).all()


def test_repeated_ids_and_vectors_of_several_lengths(spark):
    """An id counts once, of its least vector; short vectors are filled up with zeros."""
    rng = np.random.default_rng(6)
    vectors = {i: rng.normal(size=8).tolist() for i in range(60)}
    vectors |= {100 + i: rng.normal(size=3).tolist() for i in range(10)}
    rows = [(i, v) for i, v in vectors.items()] + [(i, v) for i, v in vectors.items() if i < 30] + [(5, [9.0] * 8), (7, [-9.0] * 8)]
    vectors[7] = [-9.0] * 8
    df = spark.createDataFrame([(i, v, i % 2 == 0) for i, v in rows], "vec_id long, embedding array<double>, asks boolean")
    got = {}
    for r in nearest.search(df, "asks", k=69, recall=1.0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    full = {i: np.array(v + [0.0] * (8 - len(v))) for i, v in vectors.items()}
    assert got.keys() == {i for i in full if i % 2 == 0}
    for q, rows in got.items():
        ids = [i for _, i, _ in sorted(rows)]
        assert len(ids) == len(set(ids)) and q not in ids
        assert all(s == pytest.approx(full[q] @ full[i]) for _, i, s in rows)
