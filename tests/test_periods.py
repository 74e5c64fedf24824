"""Overlapping periods, the join to very many of them, and sums kept by day."""

import random
import time
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from turnstile.operators import effective_join, interval_join, multiplied_rows, overlapping_periods
from turnstile.plans import reports
from turnstile.plans.summaries import DailySums
from turnstile.sources import Commits, VersionedTable
from turnstile.sources.tables import months

PERIOD = "k string, effective_from date, effective_to date, rate int"
DAY = date(2020, 1, 1)


def period(k, a, z, rate=0):
    on = lambda n: None if n is None else DAY + timedelta(n)
    return (k, on(a), on(z), rate)


def test_overlaps_are_found_with_their_stretch(frame):
    given = [
        period("a", 0, 9, 1), period("a", 10, 19, 2),  # next to each other
        period("b", 0, 10, 3), period("b", 10, 12, 4), period("b", 13, 13, 5), period("b", 20, None, 6), period("b", 500, 501, 7),
        period("c", 0, 100, 8), period("c", 5, 6, 9), period("c", 50, 60, 10),  # within one that ends later
        period("d", 3, 3, 11), period("d", 3, 3, 12), period("e", 9, 2, 13), period("e", 0, 20, 14),  # equal; empty
        period(None, 0, 9, 15), period(None, 0, 9, 16), period("f", None, 9, 17), period("f", 0, 9, 18),
    ]
    got = overlapping_periods(frame(PERIOD, *given), ["k"]).collect()
    stretch = {}
    for r in got:
        stretch.setdefault((r.k, r.island), set()).add(r.rate)
    assert sorted(map(sorted, stretch.values())) == [[3, 4], [6, 7], [8, 9, 10], [11, 12]]
    # Against every pair.
    rng = random.Random(4)
    many = [period(rng.choice("pq"), a, rng.choice([None, a + rng.randrange(4)]), i) for i, a in enumerate(rng.choices(range(400), k=60))]
    far = lambda p: p[2] or date.max
    want = {p[3] for p in many for q in many if p is not q and p[0] == q[0] and p[1] <= far(q) and q[1] <= far(p)}
    assert {r.rate for r in overlapping_periods(frame(PERIOD, *many), ["k"]).collect()} == want


def test_rows_that_overlaps_would_multiply(frame):
    periods = frame(PERIOD, period("a", 0, 10), period("a", 5, 20), period("b", 0, 5), period("b", 6, 9))
    sold = frame("id int, k string, day date", *[(i, k, DAY + timedelta(n) if n is not None else None) for i, (k, n) in enumerate([("a", 4), ("a", 5), ("a", 10), ("a", 11), ("b", 5), ("b", 6), (None, 5), ("a", None)])])
    assert rows(multiplied_rows(sold, periods, ["k"], "day", ["id"])) == [(1, 2), (2, 2)]


def both(sold, periods):
    plain = effective_join(sold, periods, ["k"], "day")
    binned = interval_join(sold, periods, ["k"], "day")
    assert sorted(plain.columns) == sorted(binned.columns)
    return rows(plain.select(sorted(plain.columns))), rows(binned.select(sorted(plain.columns)))


def test_binned_join_equals_the_plain_one(frame, no_broadcast):
    rng = random.Random(8)
    many = [period(rng.choice("ab"), a, rng.choice([None, a, a + rng.choice([1, 2, 3, 7, 30, 400, -5])]), i) for i, a in enumerate(rng.choices(range(-500, 500), k=120))]
    many += [period(None, 0, 9, 900), period("a", None, 9, 901)]
    sold = [(i, rng.choice(["a", "b", "z", None]), rng.choice([None, DAY + timedelta(rng.randrange(-600, 600))])) for i in range(300)]
    sold += sold[:20]  # repeated rows all come
    a, b = both(frame("id int, k string, day date", *sold), frame(PERIOD, *many))
    assert a == b and len(a) > len(sold)
    a, b = both(frame("id int, k string, day date", *sold), frame(PERIOD, *many).limit(0))
    assert a == b and len(a) == len(sold)
    a, b = both(frame("id int, k string, day date", *sold).limit(0), frame(PERIOD, *many))
    assert a == b == []


def test_ten_thousand_periods_of_one_pair(spark, no_broadcast):
    """What meets in the bins is a small multiple of what matches, not rows times periods."""
    periods = spark.range(10_000).selectExpr("'a' AS k", "date_add(DATE'1990-01-01', CAST(id AS INT)) AS effective_from", "date_add(DATE'1990-01-01', CAST(id + id % 3 AS INT)) AS effective_to", "CAST(id AS INT) AS rate")
    sold = spark.range(200_000).selectExpr("id", "'a' AS k", "date_add(DATE'1990-01-01', CAST(id % 10000 AS INT)) AS day")
    start = time.time()
    joined = interval_join(sold, periods, ["k"], "day")
    got = joined.agg(F.count("*"), F.sum("rate")).first()
    # Day n is held by the period n, by n-1 unless it lasts one day, by n-2 if it lasts three.
    want = [r for n in range(10_000) for r in (n, n - 1, n - 2) if r >= 0 and n <= r + r % 3]
    assert tuple(got) == (20 * len(want), 20 * sum(want)) and time.time() - start < 60


FACT = "sales_key string, sales_date date, sales_channel string, quantity decimal(38,0), total_amount decimal(18,2), commission_rate decimal(5,2), commission_amount decimal(18,2), updated_at timestamp_ntz"


def sale(key, month, day, amount, channel="WEB", rate="7.5"):
    d = Decimal
    return (str(key), date(2019 + (month > 12), (month - 1) % 12 + 1, day), channel, d(2), d(amount), d(rate), (d(amount) * d(rate) / 100).quantize(d("0.01")), datetime(2020, 1, 1))


@pytest.fixture
def summed(spark, frame, tmp_path):
    def open_():
        record = Commits(spark, str(tmp_path / "commits"))
        fact = VersionedTable(spark, str(tmp_path / "fact"), frame(FACT).schema, months("sales_date"), commits=record, name="fact", keys=["sales_key"])
        return fact, DailySums(fact, str(tmp_path / "sums"), months)

    return open_


def reports_agree(fact, sums):
    f, own = fact.read(), sums
    pairs = [
        (reports.weekly_by_channel(f), own.weekly_by_channel()), (reports.month_comparison(f, 2, 2020, 2019), own.month_comparison(2, 2020, 2019)),
        (reports.measures(f), own.measures()), (reports.revenue_by_year(f, "sales_date"), own.revenue_by_year()),
        (reports.report(f.withColumn("year", F.year("sales_date")), ["year"]), own.measures_by_year()),
    ]
    for full, kept in pairs:
        assert sorted(full.columns) == sorted(kept.columns)
        assert rows(full.select(sorted(full.columns))) == rows(kept.select(sorted(full.columns)))


def test_sums_follow_every_change_and_read_touched_slices_only(frame, summed):
    fact, sums = summed()
    fact.publish(frame(FACT, *[sale(k, k % 14 + 1, k % 28 + 1, k * 3 + 1, "WEB" if k % 2 else "ON_SITE") for k in range(80)]))
    assert sums.refresh() is None
    reports_agree(fact, sums)
    assert sums.refresh() == set()
    fact, sums = summed()
    before = {r.slice: r.folder for r in sums.table._manifest()}
    # A new amount, a sale moved to another month, a new one, a month that loses its last sale.
    fact.upsert(frame(FACT, sale(5, 6, 6, 1000), sale(6, 3, 7, 5), sale(500, 2, 29 - 10, 77)), ["sales_key"])
    assert sums.refresh() == {"2019-06", "2019-07", "2019-03", "2019-02"}
    assert {s for s, f in before.items() if {r.slice: r.folder for r in sums.table._manifest()}.get(s) == f} == before.keys() - {"2019-06", "2019-07", "2019-03", "2019-02"}
    reports_agree(fact, sums)
    # Readers of a fact that has moved on still see whole sums, of the version they are of.
    fact.upsert(frame(FACT, sale(501, 14, 2, 9)), ["sales_key"])
    old = rows(sums.measures())
    fact2, again = summed()
    assert rows(again.measures()) == old and again.refresh() == {"2020-02"}
    reports_agree(fact2, again)
    fact2.truncate()
    again.refresh()
    assert again.read().count() == 0
