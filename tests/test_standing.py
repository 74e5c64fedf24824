"""Checks kept from the changes alone, against the checks over whole tables."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from turnstile.operators.checks import not_null, related, run_checks, unique
from turnstile.plans.standing import StandingChecks
from turnstile.sources import Commits, VersionedTable
from turnstile.sources.tables import key_buckets, months


def test_equal_to_the_full_checks_after_every_change(spark, frame, tmp_path):
    ddl = "id int, k string, z string, day date"
    record = Commits(spark, str(tmp_path / "record"))
    child = VersionedTable(spark, str(tmp_path / "c"), frame(ddl).schema, months("day"), commits=record, name="c", keys=["id"])
    parent = VersionedTable(spark, str(tmp_path / "p"), frame("k string, z string").schema, key_buckets(["k"], 4), commits=record, name="p")
    checks = [unique("c", "k"), unique("c", "z", nulls=True), related("c", "k", "p", "k"), related("c", ("k", "z"), "p", ("k", "z"), nulls=True)]
    tables = {"c": child, "p": parent}
    make = lambda a, z: spark.range(a, z).selectExpr("CAST(id AS INT) AS id", "IF(id % 7 = 0, NULL, concat('k', id % 5)) AS k", "IF(id % 3 = 0, NULL, concat('z', id % 40)) AS z", "date_add(DATE'2020-01-01', CAST(id * 5 % 300 AS INT)) AS day")
    steps = [
        lambda: (child.publish(make(0, 60)), parent.publish(frame("k string, z string", ("k1", "z1"), ("k2", None), ("k3", "z3")))),
        lambda: child.upsert(make(50, 80).withColumn("k", F.lit("new")), ["id"]),  # values change, rows come
        lambda: parent.publish(frame("k string, z string", ("k2", None), ("new", "z1"), ("new", "z1"))),  # parents go and come
        lambda: child.draft_replace(make(3, 5).withColumn("z", F.lit("z1")), ["id"]).commit(),
        lambda: child.upsert(make(0, 2).withColumn("day", F.lit("2021-05-05").cast("date")), ["id"]),  # moves to another slice
        lambda: None,
        lambda: child.truncate(),
        lambda: child.publish(make(10, 20)),
    ]
    for k, step in enumerate(steps):
        step()
        # Opened anew, as by another run.
        got = StandingChecks(spark, str(tmp_path / "s"), checks, 4).refresh(tables)
        assert rows(got) == rows(run_checks({n: t.read() for n, t in tables.items()}, checks)), k
    with pytest.raises(ValueError, match="need no counts"):
        StandingChecks(spark, str(tmp_path / "x"), [not_null("c", "k")])


def test_only_changed_slices_are_read(spark, frame, tmp_path, monkeypatch):
    record = Commits(spark, str(tmp_path / "record"))
    df = spark.range(100).selectExpr("id", "date_add(DATE'2020-01-01', CAST(id * 3 AS INT)) AS day")
    t = VersionedTable(spark, str(tmp_path / "c"), df.schema, months("day"), commits=record, name="c", keys=["id"])
    t.publish(df)
    standing = StandingChecks(spark, str(tmp_path / "s"), [unique("c", "id")], 4)
    standing.refresh({"c": t})
    t.upsert(df.where("id = 7"), ["id"])
    opened = []
    load = t._load
    monkeypatch.setattr(t, "_load", lambda r, s=None: opened.append({x.slice for x in r}) or load(r, s))
    assert standing.refresh({"c": t}).first().failed_count == 0
    assert opened == [{"2020-01"}, {"2020-01"}]
