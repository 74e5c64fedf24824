import pytest

from turnstile.operators.checks import (
    ChecksFailed,
    accepted,
    assert_checks,
    bad_rows,
    nonempty,
    not_null,
    related,
    related_through,
    run_checks,
    unique,
)
from turnstile.plans import quality


def failures(tables, *checks):
    return {(r.table_name, r.check_name): r.failed_count for r in run_checks(tables, checks).collect()}


def test_every_kind_of_check(frame):
    t = frame("k string, v int", ("a", 1), ("a", None), ("z", 3), (None, 4), (None, -5))
    p = frame("k string", ("a",), (None,))
    got = failures(
        {"t": t, "p": p, "e": t.limit(0)},
        not_null("t", "v"), unique("t", "k"), related("t", "k", "p", "k"),
        accepted("t", "k", ["a"]), bad_rows("negative", "t", "v < 0"),
        nonempty("t"), nonempty("e"), unique("e", "k"), related("e", "k", "p", "k"),
    )
    assert got == {
        ("t", "not_null(v)"): 1, ("t", "unique(k)"): 1, ("t", "relationships(k -> p)"): 1,
        ("t", "accepted_values(k)"): 1, ("t", "negative"): 1, ("t", "nonempty"): 0,
        ("e", "nonempty"): 1, ("e", "unique(k)"): 0, ("e", "relationships(k -> p)"): 0,
    }


def test_nulls_count_in_source_validation(frame):
    t = frame("k string", ("a",), (None,), (None,))
    got = failures(
        {"t": t}, unique("t", "k", nulls=True), related("t", "k", "t", "k", nulls=True),
        accepted("t", "k", ["a"], null_passes=False),
    )
    assert list(got.values()).count(2) == 2 and got[("t", "unique(k)")] == 1


def test_pairs_as_relationship(frame):
    t = frame("o string, r string", ("o", "r"), ("o", "x"), ("o", None))
    p = frame("po string, pr string", ("o", "r"))
    assert failures({"t": t, "p": p}, related("t", ("o", "r"), "p", ("po", "pr"), nulls=True)) == {
        ("t", "relationships(o, r -> p)"): 2
    }


def test_agreement_of_the_events_organizer(frame):
    """The organizer of the event decides, not the sale's own; direct sales fail; an unknown event is skipped."""
    sales = frame(
        "event_id string, organizer_id string, reseller_id string",
        ("e1", "o2", "r1"), ("e1", "o1", "r1"), ("e2", "o1", "r1"), ("e1", "o1", None), ("e9", "o1", "r1"), ("e3", "o1", "r1"),
    )
    tables = {
        "s": sales, "e": frame("event_id string, organizer_id string", ("e1", "o1"), ("e2", "o2"), ("e3", None)),
        "a": frame("organizer_id string, reseller_id string", ("o1", "r1"), ("o1", "r1"), (None, "r1"), ("o1", None)),
    }
    got = failures(tables, related_through("s", "event_id", "e", "organizer_id", "reseller_id", "a"))
    assert got == {("s", "relationships(e.organizer_id, reseller_id -> a)"): 3}


def test_planted_defects(spark):
    """300 bad quantities, 300 bad prices, 200 bad channels, 200 bad totals."""
    sales = spark.range(100_000).selectExpr(
        "concat('T', id) AS ticket_id", "'E' AS event_id", "'C' AS customer_id", "'R' AS reseller_id",
        "IF(id >= 600 AND id < 800, 'FACEBOOK', 'WEB') AS sales_channel",
        "IF(id < 300, -1, 2) AS quantity",
        "CAST(IF(id >= 300 AND id < 600, -100, 10) AS DECIMAL(10,2)) AS unit_price",
        "CAST(IF(id >= 800 AND id < 1000, 999999, 20) AS DECIMAL(12,2)) AS total_amount",
        "DATE'2020-01-01' AS purchase_date",
    )
    named = ("quantity_positive", "unit_price_positive", "accepted_values(sales_channel)", "amount_matches")
    checks = [c for c in quality.source_checks() if c.name in named]
    got = {n: c for (_, n), c in failures({"ticket_sales": sales}, *checks).items()}
    assert got == dict(zip(named, (300, 300, 200, 800)))


def test_row_checks_share_one_scan(frame):
    t = frame("a int, b int", (1, 2))
    plan = run_checks({"t": t}, [not_null("t", "a"), not_null("t", "b"), bad_rows("x", "t", "a > b")])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_gate(frame):
    log = run_checks({"t": frame("a int", (None,))}, [not_null("t", "a")])
    with pytest.raises(ChecksFailed, match="t.not_null"):
        assert_checks(log)
    assert len(assert_checks(log, severity="warn")) == 1


def test_declared_counts():
    kinds = [c.name.split("(")[0] for c in quality.model_checks()]
    assert [kinds.count(k) for k in ("unique", "not_null", "relationships", "accepted_values")] == [14, 58, 12, 4]
