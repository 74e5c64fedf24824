from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.operators import MergeConflict
from turnstile.sources import Ledgers, VersionedTable, append_rows, land, load_by_name
from turnstile.sources.ledgers import current_watermarks
from turnstile.sources.tables import key_buckets, months


@pytest.fixture
def schema(spark):
    return T.StructType.fromDDL("k int, day date, v string, updated_at timestamp_ntz")


@pytest.fixture
def table(spark, schema, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), schema, months("day"))


def row(k, month, v, t=1):
    return (k, date(2020, month, 1), v, datetime(2020, 1, t))


def test_publish_append_truncate(frame, table, schema):
    ddl = "k int, day date, v string, updated_at timestamp_ntz"
    assert table.version == 0 and rows(table.read()) == []
    table.publish(frame(ddl, row(1, 1, "a", 2)))
    table.append(frame(ddl, row(2, 1, "b", 5)))
    assert [r[0] for r in rows(table.read())] == [1, 2]
    assert table.row_count() == 2
    assert [r[0] for r in rows(table.added(2))] == [2]
    mark = table.spark.range(1).select(table.high_mark()).first()[0]
    assert mark == datetime(2020, 1, 5)
    table.truncate()
    assert rows(table.read()) == [] and table.row_count() == 0


def test_upsert_rewrites_touched_slices_only(frame, table):
    ddl = "k int, day date, v string, updated_at timestamp_ntz"
    table.publish(frame(ddl, *[row(m, m, "old") for m in range(1, 7)]))
    before = {r.slice: r.folder for r in table._manifest()}
    # Key 2 moves from February to May; key 9 is new in June.
    table.upsert(frame(ddl, row(2, 5, "moved", 2), row(9, 6, "new", 2)), ["k"], "updated_at")
    after = {r.slice: r.folder for r in table._manifest()}
    assert [r[:3] for r in rows(table.read())] == [
        (1, date(2020, 1, 1), "old"), (2, date(2020, 5, 1), "moved"),
        (3, date(2020, 3, 1), "old"), (4, date(2020, 4, 1), "old"),
        (5, date(2020, 5, 1), "old"), (6, date(2020, 6, 1), "old"),
        (9, date(2020, 6, 1), "new"),
    ]
    same = {s for s in after if after[s] == before.get(s)}
    assert same == {"2020-01", "2020-03", "2020-04"}


def test_upsert_conflict_leaves_the_table(frame, table):
    ddl = "k int, day date, v string, updated_at timestamp_ntz"
    table.publish(frame(ddl, row(1, 1, "a")))
    with pytest.raises(MergeConflict):
        table.upsert(frame(ddl, row(1, 1, "b"), row(1, 1, "c")), ["k"])
    assert rows(table.read())[0][2] == "a" and table.version == 1


def test_unfinished_version_is_invisible(frame, table):
    ddl = "k int, day date, v string, updated_at timestamp_ntz"
    table.publish(frame(ddl, row(1, 1, "a")))
    table._write(frame(ddl, row(2, 1, "lost")), 2)  # dies before the manifest
    assert [r[0] for r in rows(table.read())] == [1]
    table.append(frame(ddl, row(3, 1, "next")))
    assert [r[0] for r in rows(table.read())] == [1, 3]


def test_repeated_upsert_changes_nothing(frame, table):
    ddl = "k int, day date, v string, updated_at timestamp_ntz"
    delta = frame(ddl, row(1, 1, "a"), row(2, 2, "b"))
    table.upsert(delta, ["k"], "updated_at")
    first = rows(table.read())
    table.upsert(delta, ["k"], "updated_at")
    assert rows(table.read()) == first


def test_evolving_upsert(frame, table):
    ddl = "k int, day date, v string, updated_at timestamp_ntz"
    table.publish(frame(ddl, row(1, 1, "a")))
    table.upsert(
        frame("k int, day date, updated_at timestamp_ntz, w int", (2, date(2020, 1, 1), datetime(2020, 1, 2), 7)),
        ["k"], evolve=True,
    )
    assert rows(table.read().select("k", "w")) == [(1, None), (2, 7)]


def test_bucket_slices_and_null_slice(spark, frame, tmp_path):
    schema = T.StructType.fromDDL("k int, day date")
    t = VersionedTable(spark, str(tmp_path / "b"), schema, key_buckets(["k"], 4))
    t.publish(spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit(None).cast("date").alias("day")))
    assert len(t._manifest()) == 4 and t.row_count() == 100
    n = VersionedTable(spark, str(tmp_path / "n"), schema, months("day"))
    n.publish(frame("k int, day date", (1, None), (2, date(2020, 1, 1))))
    assert {r.slice for r in n._manifest()} == {"none", "2020-01"}
    assert [r[0] for r in rows(n.read())] == [1, 2]


def test_land_and_load(spark, frame, tmp_path):
    df = frame("UPDATED_AT timestamp_ntz, K int", (datetime(2020, 1, 1), 1), (datetime(2020, 1, 3), 2))
    folder = str(tmp_path / "l")
    for _ in range(2):  # a repeated batch overwrites itself
        assert land(df, folder) == {"rows": 2, "mark": datetime(2020, 1, 3)}
    target = T.StructType.fromDDL("k bigint, updated_at timestamp_ntz, batch_id string")
    assert rows(load_by_name(spark, folder, target).select("k", "batch_id")) == [(1, None), (2, None)]


def test_append_counts(spark, tmp_path):
    assert append_rows(spark.range(3), str(tmp_path / "a")) == 3
    assert append_rows(spark.range(4), str(tmp_path / "a")) == 4
    assert spark.read.parquet(str(tmp_path / "a")).count() == 7


def test_watermarks(spark, tmp_path):
    ledgers = Ledgers(spark, str(tmp_path / "audit"))
    now = lambda t: F.lit(t).cast("timestamp_ntz")
    value = lambda c: spark.range(1).select(c).first()[0]
    assert value(ledgers.watermark("x")) == datetime(1900, 1, 1)
    ledgers.set_watermark("x", datetime(2020, 1, 1), "B1", now("2020-01-02"))
    ledgers.set_watermark("x", datetime(2020, 2, 1), "B2", now("2020-02-02"))
    ledgers.set_watermark("y", None, "B2", now("2020-02-02"))
    assert value(ledgers.watermark("x")) == datetime(2020, 2, 1)
    assert value(ledgers.watermark("y")) == datetime(1900, 1, 1)
    assert current_watermarks(ledgers.watermarks.read()).count() == 2


def test_new_columns_are_there_after_reopening(spark, tmp_path):
    day = "CAST('2020-01-01' AS TIMESTAMP_NTZ) AS updated_at"
    old = spark.range(3).selectExpr("id AS k", "'x' AS a", day)
    t = VersionedTable(spark, str(tmp_path / "t"), old.schema)
    t.publish(old)
    t.upsert(spark.range(1, 4).selectExpr("id AS k", "'y' AS a", "id * 2 AS b", day), ["k"], evolve=True)
    again = VersionedTable(spark, str(tmp_path / "t"), old.schema).read()
    assert rows(again.select("k", "a", "b")) == [(0, "x", None), (1, "y", 2), (2, "y", 4), (3, "y", 6)]


def test_a_span_of_days_opens_only_its_slices(spark, tmp_path):
    df = spark.range(600).selectExpr("id AS k", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS day", "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at")
    t = VersionedTable(spark, str(tmp_path / "t"), df.schema, months("day"))
    t.publish(df)
    span = t.between(date(2020, 2, 10), date(2020, 3, 5))
    assert span.count() == 25 and sorted(r.day for r in span.collect())[0] == date(2020, 2, 10)
    folders = {f.split("slice_=")[1].split("/")[0] for f in span.inputFiles()}
    assert folders == {"2020-02", "2020-03"}
    with pytest.raises(ValueError):
        VersionedTable(spark, str(tmp_path / "u"), df.schema).between(date(2020, 1, 1), date(2020, 1, 2))


def test_vacuum_keeps_what_the_newest_version_names(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS k", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS day", "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at")
    t = VersionedTable(spark, str(tmp_path / "t"), df.schema, months("day"))
    t.publish(df)
    t.upsert(df.where("k < 5"), ["k"])  # one month anew, the others carried over
    before = rows(t.read())
    assert t.vacuum() == 1 and t.vacuum() == 0
    again = VersionedTable(spark, str(tmp_path / "t"), df.schema, months("day"))
    assert rows(again.read()) == before and len(before) == 100
    again.publish(df.where("k = 0"))
    assert again.vacuum() == 2 and again.read().count() == 1
