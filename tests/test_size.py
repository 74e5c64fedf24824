"""Work that grows with the rows: small references are copied, lookups of keys alone move
no sales, alike rows meet once. Broadcasts by Spark's own estimate are all but off, as it
takes a joined table for far too large anyway."""

import time

import pytest
from helpers import rows
from pyspark.sql import functions as F

from turnstile import registry
from turnstile.operators import joins, lookup_join
from turnstile.operators.joins import measured_bytes
from turnstile.operators.latest import latest_by
from turnstile.plans import quality, star
from turnstile.registry.domain import Domain
from turnstile.registry.queries import _sales_asked


@pytest.fixture
def tiny_estimate(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lookups_by_shuffle(df):
    return [line for line in plan(df).splitlines() if "SortMergeJoin" in line and "_r_0" in line]


GIVEN = {
    "region": "SELECT CAST(id AS INT) AS r_regionkey, concat('R', id) AS r_name FROM range(2)",
    "nation": "SELECT CAST(id AS INT) AS n_nationkey, concat('N', id) AS n_name, CAST(id % 2 AS INT) AS n_regionkey FROM range(4)",
    "customer": "SELECT id % 18 AS c_custkey, concat('C', id) AS c_name, CAST(id % 4 AS INT) AS c_nationkey, CAST(id AS DOUBLE) AS c_acctbal, 'AUTO' AS c_mktsegment FROM range(20)",
    "supplier": "SELECT id % 9 AS s_suppkey, concat('S', id) AS s_name, CAST(id % 4 AS INT) AS s_nationkey, CAST(id AS DOUBLE) AS s_acctbal FROM range(10)",
    "part": "SELECT id % 28 AS p_partkey, concat('P', id) AS p_name, concat('Brand#', 1 + id % 4) AS p_brand, 'T' AS p_type, CAST(id AS INT) AS p_size, 1.5D AS p_retailprice FROM range(30)",
    "orders": "SELECT id AS o_orderkey, id % 25 AS o_custkey, 'F' AS o_orderstatus, 1.0D AS o_totalprice, TIMESTAMP_NTZ'1998-01-01 00:00:00' + make_dt_interval(CAST(id AS INT)) AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(40)",
    "lineitem": "SELECT id % 45 AS l_orderkey, id % 32 AS l_partkey, id % 11 AS l_suppkey, CAST(id % 3 AS INT) AS l_linenumber, 2.0D AS l_quantity, CAST(id AS DOUBLE) AS l_extendedprice, 0.01D AS l_discount, 0.02D AS l_tax, IF(id % 2 = 0, 'N', 'R') AS l_returnflag, 'O' AS l_linestatus, TIMESTAMP_NTZ'1998-02-01 00:00:00' AS l_shipdate FROM range(200)",
    "events": "SELECT id AS event_id, TIMESTAMP_NTZ'1999-01-01 00:00:00' AS ts, id % 10 AS user_id, 'buy' AS event_type, 5.0D AS value, concat('{\"k\": ', id % 32, '}') AS props FROM range(30)",
}


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("given"))
    for name, sql in GIVEN.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_lookups_of_the_fact_move_no_sales(spark, given, no_broadcast):
    """Repeated customers, resellers and events multiply sales, as in a plain join."""
    fact = lambda: registry.queries()["m02_fact_ticket_sales"](spark, given)
    want = rows(fact())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    got = fact()
    assert lookups_by_shuffle(got) == []
    assert rows(got) == want and len(want) == 81 > 40 + 30


def test_lines_and_orders_meet_after_one_exchange_each(spark, given, tiny_estimate):
    assert plan(Domain(spark, given).ticket_sales()).count("Exchange hashpartitioning") == 2


def test_latest_by_part_of_its_key(frame):
    df = frame("a int, b int, v int", (1, 1, 5), (1, 1, 7), (1, 2, 3), (None, 1, 2), (None, 1, 1), (2, None, 4))
    by = [F.col("v").desc()]
    assert rows(latest_by(df, ["a", "b"], by, ["a"])) == rows(latest_by(df, ["a", "b"], by))


def test_keys_alone_only_repeat_rows(frame, tiny_estimate):
    left = frame("id int, k string", (1, "a"), (2, "b"), (3, "c"), (4, None), (4, None))
    right = frame("k string", ("a",), ("b",), ("b",), ("b",), (None,), (None,), ("z",), ("z",))
    plain = lookup_join(left, right, {"k": "k"}, spread=["id"])
    measured = lookup_join(left, right, {"k": "k"}, spread=["id"], measure=True)
    assert rows(measured) == rows(plain) and len(rows(plain)) == 7
    assert lookups_by_shuffle(measured) == []


def test_measured_reference_too_large_is_not_copied(frame, tiny_estimate, monkeypatch):
    left, right = frame("id int, k string", (1, "a"), (2, None)), frame("k string, v string", ("a", "x"), ("a", "y"))
    assert measured_bytes(right) == 2 * (24 + 2)
    assert lookups_by_shuffle(lookup_join(left, right, {"k": "k"}, measure=True)) == []
    monkeypatch.setattr(joins, "COPIED", 51)
    found = lookup_join(left, right, {"k": "k"}, measure=True)
    assert len(lookups_by_shuffle(found)) == 1 and len(rows(found)) == 3


def test_many_alike_rows_and_periods_meet_once(spark, tmp_path):
    """A hundred thousand rows of one day in as many periods: ten billion matches."""
    folder, n = str(tmp_path), 100_000
    spark.sql(f"SELECT id * 97 AS o_orderkey, id * 3 AS o_custkey, TIMESTAMP_NTZ'1998-01-01 00:00:00' AS o_orderdate FROM range({n})").write.parquet(f"{folder}/orders.parquet")
    spark.sql(f"SELECT id * 3 AS l_partkey, IF(id = 0, TIMESTAMP_NTZ'1997-01-01 00:00:00', TIMESTAMP_NTZ'1998-02-01 00:00:00') AS l_shipdate FROM range({n})").write.parquet(f"{folder}/lineitem.parquet")
    start = time.time()
    got = rows(registry.queries()["j05_many_periods"](spark, folder))
    rates = sum(k * 97 % 100 for k in range(n))
    assert sorted(tuple(r) for r in got) == [(0, 1997, 1, 0, None), (0, 1998, (n - 1) * n, (n - 1) * n, (n - 1) * rates)]
    assert time.time() - start < 60


def test_checks_ask_for_their_columns_of_the_sales_only():
    checks = [c for c in quality.model_checks() if c.name.startswith("unique")]
    assert _sales_asked({"int_sales_transactions", "dim_date"}, checks) == ["sales_id", "sales_date"]
    checks = [c for c in quality.model_checks() if c.name.startswith("not_null")]
    asked = _sales_asked({"int_sales_transactions"}, checks)
    assert set(asked) == set(quality.NOT_NULL["int_sales_transactions"])
    asked = _sales_asked({"int_sales_transactions", "fact_ticket_sales"}, checks)
    assert set(star.FACT_INPUT) <= set(asked) and "customer_last_name" not in asked


def test_sales_in_a_few_periods_are_found_without_moving_them(frame, tiny_estimate):
    sales = frame("sales_id int, organizer_id string, reseller_id string, sales_date string", (1, "o", "r", "2020-01-05"), (2, "o", "r", "2020-03-05"), (3, None, "r", "2020-01-05"))
    periods = frame("organizer_id string, reseller_id string, effective_from string, effective_to string", ("o", "r", "2020-01-01", "2020-01-31"), ("o", "r", "2020-01-05", "2020-01-31"))
    dated = lambda df, *names: df.withColumns({n: F.col(n).cast("date") for n in names})
    found = star.sales_in_periods(dated(sales, "sales_date"), dated(periods, "effective_from", "effective_to"))
    assert [r[0] for r in rows(found)] == [1] and lookups_by_shuffle(found) == []
