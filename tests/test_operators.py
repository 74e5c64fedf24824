from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.operators import (
    apply_upsert,
    coerce_timestamps,
    conform,
    duplicate_keys,
    effective_join,
    high_water_mark,
    hot_for,
    hot_tokens,
    incremental_rows,
    latest_by,
    lookup_join,
    stamp_file,
    merge_conflicts,
    name_join,
    orphan_count,
    orphan_rows,
    reconcile,
    split_rejects,
    top_k_per,
)
from turnstile.plans.star import current_agreements

T0, T1, T2 = (datetime(2020, 1, d) for d in (1, 2, 3))


def test_conform_by_name(frame):
    df = frame("B string, extra int, a string", ("x", 1, "7"))
    target = T.StructType.fromDDL("a int, b string, c date")
    out = conform(df, target)
    assert out.columns == ["a", "b", "c"]
    assert rows(out) == [(7, "x", None)]


def test_coerce_timestamps_any_case(frame):
    out = coerce_timestamps(frame("Updated_At string", ("2020-01-01",), ("bad",)), ["UPDATED_AT"])
    assert rows(out) == [(datetime(2020, 1, 1),), (None,)]


def test_stamp_file(frame):
    out = stamp_file(frame("a int", (1,)), F.lit("f.csv"), F.lit("ab"), F.lit("2020-01-01").cast("timestamp_ntz"))
    assert rows(out) == [(1, "f.csv", "ab", T0)]


def test_latest_null_time_wins_and_ties_go_to_id(frame):
    schema = (
        "agreement_id int, organizer_id string, reseller_id string, effective_from date, "
        "effective_to date, commission_rate int, updated_at timestamp_ntz"
    )
    d = date(2020, 1, 1)
    df = frame(
        schema,
        (1, "o", "r", d, None, 10, T1), (2, "o", "r", d, None, 20, T0),
        (3, "o", "x", d, None, 30, T1), (4, "o", "x", d, None, 40, None),
        (5, "o", "y", d, None, 50, T1), (6, "o", "y", d, None, 60, T1),
    )
    out = current_agreements(df).select("reseller_id", "commission_rate")
    assert rows(out) == [("r", 10), ("x", 40), ("y", 60)]


def test_latest_prunes_before_the_exchange(frame):
    df = latest_by(frame("k int, v int", (1, 1)), ["k"], [F.col("v").desc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.fixture
def agreements(frame):
    return frame(
        "organizer_id string, reseller_id string, effective_from date, effective_to date, rate int",
        ("o", "r", date(2020, 1, 1), date(2020, 1, 31), 1),
        ("o", "r", date(2020, 2, 1), None, 2),
        ("o", "p", date(2020, 1, 1), date(2020, 12, 31), 3),
        ("o", "p", date(2020, 6, 1), date(2020, 6, 30), 4),
        ("o", "n", None, None, 5),
    )


def test_effective_join_edges(frame, agreements):
    sales = frame(
        "id int, organizer_id string, reseller_id string, day date",
        (1, "o", "r", date(2020, 1, 1)), (2, "o", "r", date(2020, 1, 31)),
        (3, "o", "r", date(2019, 12, 31)), (4, "o", "r", date(2500, 1, 1)),
        (5, "o", None, date(2020, 1, 5)), (6, "o", "p", date(2020, 6, 15)),
        (7, "o", "n", date(2020, 1, 1)), (8, None, "r", date(2020, 1, 1)),
        (9, "o", "r", None),
    )
    keys = ["organizer_id", "reseller_id"]
    out = effective_join(sales, agreements, keys, "day", spread=["id"]).select("id", "rate")
    assert rows(out) == [
        (1, 1), (2, 1), (3, None), (4, 2), (5, None), (6, 3), (6, 4), (7, None),
        (8, None), (9, None),
    ]


@pytest.fixture
def skewed(spark):
    """A third of the rows with one key, a third without a key."""
    key = F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE concat('k', id % 90) END")
    left = spark.range(30000).select("id", key.alias("k"))
    right = spark.range(100).select(
        F.expr("CASE WHEN id = 0 THEN 'hot' ELSE concat('k', id) END").alias("rk"),
        F.col("id").alias("v"),
    )
    return left, right


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, no_broadcast, how):
    left, right = skewed
    hot = hot_tokens(left, ["k"])
    salted = lookup_join(left, right, {"k": "rk"}, how, spread=["id"], hot=hot)
    plain = left.join(right, F.col("k") == F.col("rk"), how).drop("rk")
    assert sorted(salted.columns) == sorted(plain.columns)
    assert salted.exceptAll(plain.select(*salted.columns)).isEmpty()
    assert salted.count() == plain.count()


def test_salt_spreads_hot_and_null_keys(spark, skewed, no_broadcast):
    left, right = skewed
    hot = hot_tokens(left, ["k"])
    assert 1 <= len(hot) <= 100
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        joined = lookup_join(left, right, {"k": "rk"}, spread=["id"], hot=hot)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    # Unsalted, one of the 8 partitions would hold a third of the rows or more.
    assert max(r["count"] for r in sizes) < 30000 / 4


def test_hot_keys_are_looked_for_only_beyond_broadcast(spark, skewed):
    left, right = skewed
    assert hot_for(left, ["k"], right) == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert len(hot_for(left, ["k"], right)) >= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_keys_must_agree_in_type(spark):
    left, right = spark.range(5), spark.range(5).select(F.col("id").cast("int").alias("r"))
    with pytest.raises(TypeError):
        lookup_join(left, right, {"id": "r"}, spread=["id"], hot=[1])


def test_salted_interval_join_with_a_hot_pair(spark, no_broadcast):
    """One pair holds a third of the sales, a third has no reseller."""
    sales = spark.range(9000).selectExpr(
        "id", "'o' AS organizer_id",
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE concat('r', id % 50) END AS reseller_id",
        "date_add(DATE'2020-01-01', CAST(id % 700 AS INT)) AS day",
    )
    terms = spark.range(51).selectExpr(
        "'o' AS organizer_id", "IF(id = 50, 'hot', concat('r', id)) AS reseller_id", "id AS rate",
        "inline(array(struct(DATE'2020-02-01' AS effective_from, DATE'2020-12-31' AS effective_to),"
        " struct(DATE'2020-12-01' AS effective_from, CAST(NULL AS DATE) AS effective_to)))",
    )
    keys = ["organizer_id", "reseller_id"]
    hot = hot_tokens(sales, keys)
    assert hot
    salted = effective_join(sales, terms, keys, "day", spread=["id"], hot=hot)
    plain = sales.alias("s").join(
        terms.alias("t"),
        F.expr("s.organizer_id = t.organizer_id AND s.reseller_id = t.reseller_id AND day >= effective_from"
               " AND (effective_to IS NULL OR day <= effective_to)"),
        "left",
    ).select("id", "s.organizer_id", "s.reseller_id", "day", "rate")
    salted = salted.select(*plain.columns)
    assert salted.count() == plain.count() > 9000
    assert salted.exceptAll(plain).isEmpty()


def test_name_join_normalises_and_fans_out(frame):
    left = frame("id int, name string", (1, " Rock Night "), (2, "none"), (3, None))
    right = frame("known string, e int", ("ROCK night", 10), ("rock night ", 11), ("Jazz", 12))
    out = name_join(left, right, "name", "known", ["id"]).select("id", "e")
    assert rows(out) == [(1, 10), (1, 11), (2, None), (3, None)]


def test_orphans(frame):
    child = frame("id int, k string", (1, "a"), (2, "z"), (3, "z"), (4, None))
    parent = frame("k string", ("a",), ("a",), (None,))
    assert orphan_count(child, parent, {"k": "k"}).first()[0] == 3
    assert orphan_count(child, parent, {"k": "k"}, count_nulls=False).first()[0] == 2
    assert rows(orphan_rows(child, parent, {"k": "k"}, ["id"])) == [(2, "z"), (3, "z")]
    assert orphan_count(child.limit(0), parent, {"k": "k"}).first()[0] == 0


def test_upsert_rules(frame):
    schema = "k int, v string, t timestamp_ntz"
    target = frame(
        schema, (1, "old", T1), (2, "old", T1), (3, "old", T1), (4, "old", None),
        (5, "kept", T1), (None, "kept", T1),
    )
    source = frame(
        schema, (1, "new", T2), (2, "new", T1), (3, "new", T0), (4, "new", T2),
        (6, "added", None), (7, "twice", T1), (7, "twice", T2), (None, "added", T1),
    )
    plain = apply_upsert(target, source, ["k"]).select("k", "v")
    assert rows(plain) == [
        (1, "new"), (2, "new"), (3, "new"), (4, "new"), (5, "kept"), (6, "added"),
        (7, "twice"), (7, "twice"), (None, "added"), (None, "kept"),
    ]
    guarded = apply_upsert(target, source, ["k"], guard="t").select("k", "v")
    assert rows(guarded)[:5] == [(1, "new"), (2, "old"), (3, "old"), (4, "old"), (5, "kept")]
    assert merge_conflicts(target, source, ["k"]).isEmpty()
    twice = source.union(source.where("k = 1"))
    assert rows(merge_conflicts(target, twice, ["k"])) == [(1,)]


def test_reconcile_adds_and_drops(frame):
    target = frame("k int, gone int, v int", (1, 9, 5))
    source = frame("k int, v bigint, added string", (2, 6, "x"))
    t, s = reconcile(target, source)
    assert rows(apply_upsert(t, s, ["k"])) == [(1, 5, None), (2, 6, "x")]


def test_incremental_is_strict_and_shared(frame):
    schema = "id int, feed string, updated_at timestamp_ntz"
    target = frame(schema, (1, "db", T0), (2, "file", T1))
    late = frame(schema, (3, "db", T1), (4, "db", datetime(2020, 1, 1, 12)), (5, "db", T2))
    assert [r[0] for r in rows(incremental_rows(late, target))] == [5]
    assert [r[0] for r in rows(incremental_rows(late, target, lateness="1 day"))] == [3, 4, 5]
    assert [r[0] for r in rows(incremental_rows(late, target, by="feed"))] == [3, 4, 5]
    assert len(rows(incremental_rows(late, target.limit(0)))) == 3
    assert high_water_mark(target.limit(0)).first()[0] == datetime(1900, 1, 1)


def test_duplicates(frame):
    df = frame("k string", ("a",), ("a",), ("b",), (None,), (None,))
    assert rows(duplicate_keys(df, ["k"], skip_nulls=True)) == [("a", 2)]
    assert rows(duplicate_keys(df, ["k"])) == [("None", 2)] or len(rows(duplicate_keys(df, ["k"]))) == 2


def test_top_k_per_group(frame):
    df = frame("g string, v int", ("a", 1), ("a", 3), ("a", 2), ("b", 1))
    assert rows(top_k_per(df, ["g"], [F.col("v").desc()], 2)) == [
        ("a", 2, 2), ("a", 3, 1), ("b", 1, 1)
    ]


def test_rejects_keep_reason_and_content(frame):
    df = frame("id int, v string", (1, "ok"), (2, None))
    good, bad = split_rejects(
        df, {"no v": F.col("v").isNull()}, "B", "s", F.lit("2020-01-01").cast("timestamp_ntz")
    )
    assert rows(good) == [(1, "ok")]
    r = bad.first()
    assert (r.reason, r.raw_payload, r.source_file) == ("no v", '{"id":2,"v":null}', None)


def test_decimal_round_is_half_up(spark):
    x = F.lit(Decimal("7.325")).cast("decimal(10,3)")
    assert spark.range(1).select(F.round(x, 2)).first()[0] == Decimal("7.33")
