"""Merges that move only what changes: rows that share no key's hash pass by the join."""

import sys
from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_size import given  # noqa: F401

from turnstile import registry
from turnstile.operators import MergeConflict, apply_upsert, upsert, upsert_by_hash
from turnstile.sources import VersionedTable
from turnstile.sources import tables as versioned
from turnstile.sources.tables import months

DDL = "k string, day date, v string, updated_at timestamp_ntz"


def row(k, month, v, t=1):
    return (k, date(2020, month, 1), v, datetime(2020, 1, t))


@pytest.fixture
def opened(spark, tmp_path):
    return lambda **more: VersionedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(DDL), months("day"), keys=["k"], **more)


def test_equal_to_the_plain_upsert(frame, monkeypatch):
    target = frame("k string, g int, v string", ("a", 1, "t"), ("a", 2, "t"), ("b", 5, "t"), (None, 1, "t"), (None, 1, "t"), ("c", None, "t"))
    source = frame("k string, g int, v string", ("a", 2, "s"), ("b", 4, "s"), (None, 9, "s"), ("d", 1, "s"), ("d", 2, "s"), ("c", 1, "s"))
    for guard in (None, "g"):
        want = rows(apply_upsert(target, source, ["k"], guard))
        assert rows(upsert_by_hash(target, source, ["k"], guard)) == want and len(want) == 9
    monkeypatch.setattr(upsert, "copied_if_small", lambda df: None)  # too many keys are shared
    assert rows(upsert_by_hash(target, source, ["k"])) == rows(apply_upsert(target, source, ["k"]))


def test_keys_of_other_types_meet_as_before(frame):
    target, source = frame("k int, v string", (1, "t"), (2, "t")), frame("k bigint, v string", (2, "s"), (3, "s"))
    assert rows(upsert_by_hash(target, source, ["k"])) == rows(apply_upsert(target, source, ["k"]))


def test_only_rows_that_meet_are_joined(frame):
    target, source = frame("k string, v string", ("a", "t")), frame("k string, v string", ("b", "s"))
    plan = upsert_by_hash(target, source, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Union" in plan


def test_new_rows_leave_a_slice_as_it_is(frame, opened):
    t = opened()
    t.publish(frame(DDL, *[row(f"k{m}", m, "old") for m in (1, 2, 3)]))
    before = {(r.slice, r.folder) for r in t._manifest() if r.slice.startswith("2020")}
    t.upsert(frame(DDL, row("k2", 2, "new", 2), row("n", 3, "new", 2), row(None, 3, "null", 2)), ["k"])
    after = {(r.slice, r.folder) for r in t._manifest() if r.slice.startswith("2020")}
    assert {s for s, _ in before - after} == {"2020-02"}  # the only one rewritten
    assert [r[:3:2] for r in rows(t.read())] == [(None, "null"), ("k1", "old"), ("k2", "new"), ("k3", "old"), ("n", "new")]
    with pytest.raises(MergeConflict):
        opened().upsert(frame(DDL, row("n", 3, "x"), row("n", 3, "y")), ["k"])
    moved = opened()
    moved.upsert(frame(DDL, row("k1", 3, "moved", 3)), ["k"])
    assert [r[:3] for r in rows(moved.read()) if r[0] == "k1"] == [("k1", date(2020, 3, 1), "moved")]


def test_a_slice_of_many_folders_becomes_one(frame, opened, monkeypatch):
    monkeypatch.setattr(versioned, "_COMPACT", 2)
    t = opened()
    for n in range(5):
        t.upsert(frame(DDL, row(f"k{n}", 1, "v")), ["k"])
        assert sum(r.slice == "2020-01" for r in t._manifest()) <= 2
    t.upsert(frame(DDL, *[row(f"k{n}", 1, "w", 2) for n in range(2)]), ["k"])
    assert [r[:3:2] for r in rows(opened().read())] == [("k0", "w"), ("k1", "w"), ("k2", "v"), ("k3", "v"), ("k4", "v")]


def test_derived_columns_are_not_moved(frame, opened):
    t = opened(derived={"v": F.md5("k")})
    df = frame(DDL, row("a", 1, None), row("b", 2, None)).withColumn("v", F.md5("k"))
    t.publish(df)
    assert rows(t.read()) == rows(df)
    t.upsert(df.where("k = 'a'"), ["k"])
    assert rows(t.read()) == rows(df)


@pytest.mark.parametrize("name", ["i05_both_feeds_stored_target", "r01_weekly_kept_up_to_date", "q16_write_audit_publish", "i05_incremental_fact", "i05_shared_mark_loses_late_rows", "i05_mark_per_feed"])
def test_tickets_are_worked_out_once(spark, given, monkeypatch, name):
    """What several steps read comes from landed rows: the given lines are planned into one write."""
    queries = sys.modules["turnstile.registry.queries"]
    landed = []
    real = queries.land
    monkeypatch.setattr(queries, "land", lambda df, *a: landed.append("lineitem" in ",".join(df.inputFiles())) or real(df, *a))
    found = registry.queries()[name](spark, given)
    assert sum(landed) == 1 and not any("lineitem" in f for f in found.inputFiles())
