"""What is too large to be copied is met part by part: rows land in parts by key, each part
of the reference is copied; a replaced key's neighbours stay where they are."""

import sys
from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_size import given  # noqa: F401

from turnstile import registry
from turnstile.operators import joins
from turnstile.operators.joins import part_of, parts_of
from turnstile.plans import star
from turnstile.sources import Parted, VersionedTable, land
from turnstile.sources.tables import months

DDL = "k string, day date, v string, updated_at timestamp_ntz"


def row(k, month, v):
    return (k, date(2020, month, 1), v, datetime(2020, 1, 1))


def test_landed_parts_are_the_rows(spark, frame, tmp_path):
    df = frame(DDL, *[row(f"k{n}", 1 + n % 3, "v") for n in range(9)], (None, None, "n", None))
    parts = Parted(spark, str(tmp_path / "p"), df.schema)
    assert land(df, parts.folder, "updated_at", part_of(["k"], 3))["rows"] == 10
    assert rows(parts.read()) == rows(df) == rows(parts.gathered())
    for i in range(4):
        assert rows(parts.only(i)) == rows(df.where(part_of(["k"], 3) == i))
    by_month = Parted(spark, str(tmp_path / "m"), df.schema)
    land(df, by_month.folder, "updated_at", F.date_format("day", "yyyy-MM"))
    assert rows(by_month.only("none")) == [(None, None, "n", None)]
    tasks = by_month.gathered().withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count_distinct(F.month("day")).alias("n"))
    assert [r.n <= 1 for r in tasks.collect()] == [True] * tasks.count() and tasks.count() >= 4  # not one for all
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"


def test_parts_by_size(spark, monkeypatch, no_broadcast):
    df = spark.range(1000).selectExpr("id")
    monkeypatch.setattr(joins, "COPIED", 4000)
    assert parts_of(df, ["id"]) == 1  # broadcasts are off
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    assert parts_of(df, ["id"]) == 6 and parts_of(df.limit(10), ["id"]) == 1


@pytest.mark.parametrize("name", ["i05_rerated_fact", "i05_both_feeds_stored_target", "r01_weekly_kept_up_to_date"])
def test_equal_by_parts(spark, given, monkeypatch, name):  # noqa: F811
    """Events, agreements and hashes of keys are too many to be copied at once."""
    query = registry.queries()[name]
    want = rows(query(spark, given))
    queries = sys.modules["turnstile.registry.queries"]
    met = []
    real = star.fact_ticket_sales
    monkeypatch.setattr(star, "fact_ticket_sales", lambda s, a, *x, **y: met.append(a.inputFiles()) or real(s, a, *x, **y))
    monkeypatch.setattr(joins, "COPIED", 900)
    assert queries._event_parts(queries.Domain(spark, given)) > 1
    assert rows(query(spark, given)) == want and want
    assert len(met) > 2 and not any("supplier" in f for files in met for f in files)


def test_single_sales_are_rerated_one_by_one(frame):
    sale = "sales_id string, sales_source string, organizer_id string, reseller_id string, sales_date date"
    day = date(2020, 1, 5)
    sales = frame(sale, ("a", "S", "O", "R", day), ("b", "S", "O", "R", date(2021, 1, 1)), ("c", "S", "O", None, day), (None, "S", "O", "R", day), ("d", "S", "O", "Q", day))
    periods = frame("organizer_id string, reseller_id string, effective_from date, effective_to date", ("O", "R", date(2020, 1, 1), date(2020, 2, 1)))
    for changed in (sales.limit(0), sales.where("sales_id IN ('a', 'c')")):
        want = rows(star.rerated_sales(sales, changed, periods))
        assert rows(star.rerated_sales(sales, changed, periods, single=True)) == want and len(want) >= 1


@pytest.mark.parametrize("copied", [32, 64, 2**20])
@pytest.mark.parametrize("alike", [False, True])
def test_replaced_keys_leave_other_rows_in_place(spark, frame, tmp_path, monkeypatch, copied, alike):
    if alike:  # keys of one first letter share a hash
        real = F.xxhash64
        monkeypatch.setattr(F, "xxhash64", lambda *c: real(*[F.substring(F.col(k) if isinstance(k, str) else k, 1, 1) for k in c]))
    t = VersionedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(DDL), months("day"), keys=["k"], directory=4)
    t.publish(frame(DDL, *[row(f"{a}{n}", m, "old") for a in "abcdefgh" for n in (1, 2) for m in (1, 2)], row(None, 1, "null"), row("z", 3, "far")))
    monkeypatch.setattr(joins, "COPIED", copied)
    written = []
    write = t._write
    monkeypatch.setattr(t, "_write", lambda df, version, schema, kept, *x: written.append((df, kept)) or write(df, version, schema, kept, *x))
    new = frame(DDL, *[row(f"{a}1", 2, "new") for a in "abcdef"], row(None, 4, "null"))
    new.write.parquet(str(tmp_path / "new"))
    t.draft_replace(spark.read.schema(new.schema).parquet(str(tmp_path / "new")), ["k"]).commit()
    want = [row(f"{a}{n}", m, "old") for a in "abcdefgh" for n in (1, 2) for m in (1, 2) if (a in "gh" or n == 2)]
    want += [row(f"{a}1", 2, "new") for a in "abcdef"] + [row(None, 1, "null"), row(None, 4, "null"), row("z", 3, "far")]
    assert rows(t.read()) == sorted(want, key=lambda r: tuple(map(str, r)))
    content, kept = written[0]
    assert kept and not any("/data/v1/" in f for f in content.inputFiles())
    assert len(kept) > 1 or copied > 64


def test_gathered_new_rows_are_not_moved(spark, frame, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(DDL), months("day"), keys=["k"], directory=4)
    t.publish(frame(DDL, row("a", 1, "old"), row("b", 2, "old"), row(None, 1, "null")))
    delta = Parted(spark, str(tmp_path / "d"), t.schema)
    land(frame(DDL, row("a", 2, "new"), row("c", 1, "new"), row("d", 3, "new"), row(None, 2, "null")), delta.folder, "updated_at", F.date_format("day", "yyyy-MM"))
    written = []
    write = t._write
    monkeypatch.setattr(t, "_write", lambda df, *x: written.append(df) or write(df, *x))
    t.upsert(delta.read(), ["k"], gathered=delta.gathered())
    want = [row("a", 2, "new"), row("b", 2, "old"), row("c", 1, "new"), row("d", 3, "new"), row(None, 1, "null"), row(None, 2, "null")]
    assert rows(t.read()) == sorted(want, key=lambda r: tuple(map(str, r)))
    assert [r.k for r in written[0].collect()] == ["a"]  # the one that met a stored row
