import zlib
from collections import Counter

from pyspark.sql import functions as F

from turnstile.llm import sharding


def test_the_permutation_is_a_bijection_for_any_size(spark):
    for n in (1, 2, 3, 10, 97, 1000, 4099):
        steps = sharding.walks(spark, n, 5)
        place = spark.range(n).select(sharding.permuted(F.col("id"), n, 5, steps).alias("p"))
        assert sorted(r["p"] for r in place.collect()) == list(range(n))


def test_the_order_is_shuffled_and_depends_on_the_seed(spark):
    place = lambda seed: [r[0] for r in spark.range(500).select(sharding.permuted(F.col("id"), 500, seed, sharding.walks(spark, 500, seed))).collect()]
    one = place(1)
    assert one == place(1) and one != place(2)
    assert sum(abs(a - b) < 25 for a, b in zip(one, one[1:], strict=False)) < 120


def test_numbers_are_gapless_in_key_order(spark):
    df = spark.createDataFrame([(k % 7 if k % 5 else None, k) for k in range(100)], "a int, b int")
    got = sorted((r["row_no"], r["a"] is not None, r["a"], r["b"]) for r in sharding.numbered(df, ["a", "b"]).collect())
    assert [g[0] for g in got] == list(range(100))
    assert [g[1:] for g in got] == sorted([g[1:] for g in got], key=lambda g: (g[0], g[1] or 0, g[2]))


def test_shards_are_even_and_rows_whole(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (None, "é"), (3, "")] + [(k, "x" * (k % 50)) for k in range(10, 300)]
    docs = spark.createDataFrame([(*r, "shard", 7) for r in rows], "doc_id long, text string, law string, shard int")
    got = sharding.shard_rows(docs, 7).collect()
    assert len(got) == len(rows)
    size = Counter(r["shard"] for r in got)
    assert set(size) == set(range(7)) and max(size.values()) - min(size.values()) <= 1
    for s in range(7):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(size[s]))
    expect = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expect
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}


def test_the_same_rows_in_another_order_go_to_the_same_places(spark):
    rows = [(k, f"text {k}") for k in range(200)]
    where = lambda given, parts: {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_rows(spark.createDataFrame(given, "doc_id long, text string").repartition(parts), 9).collect()}
    assert where(rows, 2) == where(rows[::-1], 5)


def test_fewer_rows_than_shards_and_none(spark):
    schema = "doc_id long, text string"
    assert sharding.shard_rows(spark.createDataFrame([], schema), 40).count() == 0
    got = sharding.shard_rows(spark.createDataFrame([(1, "a"), (2, "b")], schema), 40).collect()
    assert len({r["shard"] for r in got}) == 2 and {r["slot"] for r in got} == {0}
