"""Both feeds, the models and the gate, end to end on small tables."""

from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from turnstile import schemas
from turnstile.fixed import DROP_HEADERS
from turnstile.operators.checks import ChecksFailed, bad_rows
from turnstile.operators.shape import conform
from turnstile.plans import reports, sales, star
from turnstile.plans.warehouse import Warehouse

LOADED = [
    "sales_id", "sales_source", "reseller_id", "organizer_id", "quantity", "unit_price",
    "total_amount", "commission_rate", "commission_amount",
]


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def tickets(spark, first, last, month=1, quantity=2):
    """Tickets ``first`` to ``last``, changed on the day of their number."""
    return spark.range(first, last + 1).selectExpr(
        "concat('TKT', id) AS ticket_id", "concat('E', id % 3) AS event_id", "'O1' AS organizer_id",
        "IF(id % 4 = 0, NULL, concat('R', id % 2)) AS reseller_id",
        "IF(id % 4 = 0, 'organizer', 'reseller') AS seller_type", "'S' AS seller_id", "'s' AS seller_name",
        "concat('C', id % 5) AS customer_id", "'web' AS sales_channel", f"{quantity} AS quantity",
        "10.00 AS unit_price", f"10.00 * {quantity} AS total_amount",
        f"date_add(DATE'2020-0{month}-01', CAST(id % 28 AS INT)) AS purchase_date",
        f"CAST(DATE'2020-0{month}-01' AS TIMESTAMP_NTZ) + make_dt_interval(CAST(id AS INT)) AS updated_at",
    )


@pytest.fixture
def sources(spark):
    day = "CAST('2020-01-01' AS TIMESTAMP_NTZ) AS updated_at"
    named = {
        "organizers": spark.range(2).selectExpr("concat('O', id) AS organizer_id", "'Org' AS organizer_name", "'x' AS country", "'tx' AS region", day),
        "resellers": spark.range(2).selectExpr("concat('R', id) AS reseller_id", "concat('Res ', id) AS reseller_name", "'us' AS country", "'tx' AS region", day),
        "commission_agreements": spark.range(2).selectExpr(
            "id AS agreement_id", "'O1' AS organizer_id", "concat('R', id) AS reseller_id", "7.5 + id AS commission_rate",
            "DATE'2019-01-01' AS effective_from", "CAST(NULL AS DATE) AS effective_to", day),
        "events": spark.range(3).selectExpr(
            "concat('E', id) AS event_id", "'O1' AS organizer_id", "concat('Show ', id) AS event_name", "'Music' AS event_type",
            "'Hall' AS venue", "'tx' AS region", "DATE'2020-05-01' AS event_date", day),
        "customers": spark.range(5).selectExpr(
            "concat('C', id) AS customer_id", "'ann' AS first_name", "'lee' AS last_name", "concat(id, '@x.org') AS email", "'us' AS country", day),
    }

    def build(sales):
        return {n: conform(df, schemas.SOURCES[n]) for n, df in {**named, "ticket_sales": sales}.items()}

    return build


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()

    def put(name, *lines):
        (folder / name).write_text("\n".join([",".join(DROP_HEADERS), *lines]) + "\n")
        return str(folder)

    return put


def fact(w):
    return rows(w.fact.read().select(*LOADED))


def test_increments_equal_one_full_build(spark, sources, inbox, tmp_path):
    folder = inbox("DailySales_01052020_R1.csv", "901, SHOW 1 ,3,30.00,on_site,mary-jane,lee,Office,2020-01-05")
    # Marks per feed, so that the file load does not hide later tickets.
    w = Warehouse(spark, str(tmp_path / "step"))
    assert w.load_tables(sources(tickets(spark, 1, 20)), "B1", at("2020-06-01"))["ticket_sales"] == 20
    w.load_files(folder, "F1", at("2020-06-01"))
    w.build("B1", at("2020-06-01"), by="source_system")
    # Ten new tickets and new quantities for five old ones.
    changed = tickets(spark, 16, 20, month=2, quantity=5).unionByName(tickets(spark, 21, 30))
    everything = tickets(spark, 1, 15).unionByName(changed)
    counts = w.load_tables(sources(everything), "B2", at("2020-06-02"))
    assert counts["ticket_sales"] == 15 and counts["events"] == 0
    w.build("B2", at("2020-06-02"), by="source_system", rebuild_sales=False)

    full = Warehouse(spark, str(tmp_path / "full"))
    full.load_tables(sources(everything), "B9", at("2020-06-03"))
    full.load_files(folder, "F9", at("2020-06-03"))
    full.build("B9", at("2020-06-03"))
    assert len(fact(full)) == 31
    assert fact(w) == fact(full)

    mart = w.mart()
    assert {n: df.count() for n, df in mart.items()}["dim_event"] == 3
    vendor = [r for r in fact(w) if r[1] == "VENDOR PLATFORM"][0]
    assert [str(v) for v in vendor[2:]] == ["R1", "O1", "3", "10.00000000", "30.00", "8.50", "2.55"]
    total = reports.measures(mart["fact_ticket_sales"]).first()
    assert total.transactions == 31
    # Every build leaves its checks in the log, all passed.
    log = w.ledgers.checks.read()
    assert log.where("status <> 'PASS'").isEmpty()
    assert log.where("batch_id LIKE 'B1%'").count() == 92


def test_shared_mark_loses_older_tickets(spark, sources, inbox, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    w.load_tables(sources(tickets(spark, 1, 5)), "B1", at("2020-06-01"))
    w.load_files(inbox("DailySales_01052020_R1.csv", "901,Show 1,3,30.00,web,a,b,Office,2020-01-05"), "F1", at("2020-06-01"))
    w.build("B1", at("2020-06-01"))
    w.load_tables(sources(tickets(spark, 1, 9)), "B2", at("2020-06-02"))
    w.build("B2", at("2020-06-02"))
    assert len(fact(w)) == 6  # tickets 6 to 9 changed before the file load: lost


def test_repeated_runs_change_nothing(spark, sources, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    for batch in ("B1", "B2"):
        w.load_tables(sources(tickets(spark, 1, 9)), batch, at("2020-06-01"))
        w.build(batch, at("2020-06-01"))
    assert len(fact(w)) == 9
    assert w.raw["ticket_sales"].row_count() == 9


def test_failed_check_stops_the_build(spark, sources, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    bad = tickets(spark, 1, 4).withColumn("sales_channel", F.lit("facebook"))
    w.load_tables(sources(bad), "B1", at("2020-06-01"))
    with pytest.raises(ChecksFailed, match="accepted_values"):
        w.build("B1", at("2020-06-01"))
    assert not w.fact.exists()
    failed = w.ledgers.checks.read().where("status = 'FAIL'")
    assert rows(failed.select("check_name", "failed_count")) == [("accepted_values(sales_channel)", 4)]


def test_failed_load_moves_no_mark(spark, sources, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    w.load_tables(sources(tickets(spark, 1, 4)), "B1", at("2020-06-01"))
    later = tickets(spark, 5, 6)
    twice = tickets(spark, 1, 1, month=3)
    with pytest.raises(Exception, match="several new rows"):
        w.load_tables(sources(later.unionByName(twice).unionByName(twice)), "B2", at("2020-06-02"))
    mark = spark.range(1).select(w.ledgers.watermark("ticket_sales")).first()[0]
    assert mark == datetime(2020, 1, 5)
    jobs = w.ledgers.jobs.read().select("status", "records_loaded")
    assert rows(jobs) == [("FAILED", 0), ("SUCCESS", 18)]
    assert w.load_tables(sources(later), "B3", at("2020-06-03"))["ticket_sales"] == 2


def test_full_reload(spark, sources, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    w.load_tables(sources(tickets(spark, 1, 4)), "B1", at("2020-06-01"))
    w.full_reload("B2", at("2020-06-02"))
    assert w.raw["ticket_sales"].row_count() == 0
    assert w.load_tables(sources(tickets(spark, 1, 4)), "B3", at("2020-06-03"))["ticket_sales"] == 4


def test_full_reload_brings_the_files_back(spark, inbox, tmp_path):
    folder = inbox("DailySales_01052020_R1.csv", "901,Show 1,3,30.00,web,a,b,Office,2020-01-05")
    w = Warehouse(spark, str(tmp_path / "w"))
    w.load_files(folder, "F1", at("2020-06-01"))
    w.full_reload("B2", at("2020-06-02"))
    assert w.raw["reseller_daily_sales"].row_count() == 0
    assert w.load_files(folder, "F2", at("2020-06-03"))["rows"] == 1
    assert w.raw["reseller_daily_sales"].read().count() == 1


def test_a_repaired_run_passes_the_gate_under_the_same_id(spark, sources, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    w.load_tables(sources(tickets(spark, 1, 4).withColumn("sales_channel", F.lit("facebook"))), "B1", at("2020-06-01"))
    with pytest.raises(ChecksFailed):
        w.build("B1", at("2020-06-01"))
    jobs = rows(w.ledgers.jobs.read().where("job_name = 'build'").select("status", "error_message"))
    assert len(jobs) == 1 and jobs[0][0] == "FAILED" and "accepted_values" in jobs[0][1]
    mended = tickets(spark, 1, 4).withColumn("updated_at", F.col("updated_at") + F.expr("interval 60 days"))
    w.load_tables(sources(mended), "B1", at("2020-06-02"))
    w.build("B1", at("2020-06-02"))
    assert len(fact(w)) == 4


def test_failed_file_loads_are_audited(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(Exception, match="missing"):
        w.load_files(str(tmp_path / "missing"), "F1", at("2020-06-01"))
    job = w.ledgers.jobs.read().first()
    assert job.status == "FAILED" and "missing" in job.error_message


def test_times_that_are_no_times_do_not_stop_the_load(spark, sources, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    text = tickets(spark, 1, 4).withColumn("updated_at", F.expr("IF(ticket_id = 'TKT2', 'soon', CAST(updated_at AS STRING))"))
    given = {"ticket_sales": text.selectExpr(*[c if c == "updated_at" else f"CAST({c} AS {t.dataType.simpleString()}) AS {c}" for c, t in zip(schemas.SOURCES["ticket_sales"].fieldNames(), schemas.SOURCES["ticket_sales"])])}
    assert w.load_tables(given, "B1", at("2020-06-01"))["ticket_sales"] == 3


def test_a_failing_fact_check_leaves_readers_on_the_old_rows(spark, sources, tmp_path, monkeypatch):
    """Neither the fact nor a dimension of the refused build is seen; a mended one is."""
    root = str(tmp_path / "w")
    w = Warehouse(spark, root)
    w.load_tables(sources(tickets(spark, 1, 9)), "B1", at("2020-06-01"))
    w.build("B1", at("2020-06-01"))
    old = {n: rows(df) for n, df in w.mart().items()}
    w.load_tables(sources(tickets(spark, 1, 20)), "B2", at("2020-06-02"))
    with monkeypatch.context() as m:
        m.setattr(w, "_checks", lambda prefix: [bad_rows("never", "fact_ticket_sales", "true")] if prefix == "fact_" else [])
        with pytest.raises(ChecksFailed, match="never"):
            w.build("B2", at("2020-06-02"))
    for reader in (w, Warehouse(spark, root)):
        assert {n: rows(df) for n, df in reader.mart().items()} == old
    log = w.ledgers.checks.read().where("batch_id = 'B2-fact'").first()
    assert (log.status, log.failed_count) == ("FAIL", 20)
    assert w.build("B3", at("2020-06-03"))["fact_ticket_sales"] == 20
    new = {n: rows(df) for n, df in Warehouse(spark, root).mart().items()}
    assert len(new["fact_ticket_sales"]) == 20 and len(new["dim_date"]) > len(old["dim_date"])


def test_a_load_that_dies_between_two_tables_shows_old_rows(spark, sources, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    Warehouse(spark, root).load_tables(sources(tickets(spark, 1, 4)), "B1", at("2020-06-01"))
    w = Warehouse(spark, root)
    later = sources(tickets(spark, 1, 9))
    later["events"] = later["events"].withColumns({"event_name": F.lit("Other"), "updated_at": at("2020-03-01")})

    def dies(*_):
        raise RuntimeError("the machine is gone")

    monkeypatch.setattr(w.raw["ticket_sales"], "draft_upsert", dies)
    with pytest.raises(RuntimeError, match="gone"):
        w.load_tables(later, "B2", at("2020-06-02"))
    seen = Warehouse(spark, root)
    assert seen.raw["ticket_sales"].row_count() == 4
    assert {r.event_name for r in seen.raw["events"].read().collect()} == {"Show 0", "Show 1", "Show 2"}
    # The events' merge was written; only the record does not name it.
    assert seen.raw["events"]._log().agg(F.max("version")).first()[0] >= seen.raw["events"].version
    counts = seen.load_tables(later, "B3", at("2020-06-03"))
    assert (counts["ticket_sales"], counts["events"]) == (5, 3)
    done = Warehouse(spark, root)
    assert done.raw["ticket_sales"].row_count() == 9 and {r.event_name for r in done.raw["events"].read().collect()} == {"Other"}


def agreements(spark, *rows_):
    """(id, reseller, rate, from, to, day of change in March)"""
    df = spark.createDataFrame(rows_, "id int, r string, rate double, a string, z string, d int")
    return df.selectExpr(
        "id AS agreement_id", "'O1' AS organizer_id", "r AS reseller_id", "rate AS commission_rate", "CAST(a AS DATE) AS effective_from",
        "CAST(z AS DATE) AS effective_to", "CAST(make_date(2020, 3, d) AS TIMESTAMP_NTZ) AS updated_at")


def unified(w):
    """The sales that the last build stored."""
    return w._table("intermediate/sales", sales.unified_sales(w.staged()).schema).read()


def test_rerated_facts_equal_a_full_build(spark, sources, tmp_path):
    """A new rate and a period that moves, then an overlap that multiplies sales; with new sales in between. Only touched months are written."""
    steps = [
        [(1, "R0", 5.0, "2019-01-01", None, 1), (2, "R1", 7.0, "2020-01-01", "2020-01-10", 1)],
        [(1, "R0", 6.0, "2019-01-01", "2020-03-01", 2), (2, "R1", 7.0, "2020-01-05", "2020-01-12", 2)],
        [(3, "R0", 9.0, "2020-01-03", "2020-01-04", 4)],
    ]
    root = str(tmp_path / "w")
    state, may = {}, None
    for k, step in enumerate(steps):
        state |= {r[0]: r for r in step}
        sold = tickets(spark, 1, 20 + k).unionByName(tickets(spark, 40, 43, month=5).withColumn("reseller_id", F.lit(None)).withColumn("updated_at", at("2020-01-01")))
        given = sources(sold) | {"commission_agreements": conform(agreements(spark, *state.values()), schemas.SOURCES["commission_agreements"])}
        w = Warehouse(spark, root)
        w.load_tables(given, f"B{k}", at("2020-06-01"))
        w.build(f"B{k}", at("2020-06-01"), rerate=True)
        full = star.fact_ticket_sales(unified(w), w.staged()["commission_agreements"])
        assert fact(w) == rows(full.select(*LOADED))
        folder = {r.slice: r.folder for r in w.fact._manifest()}["2020-05"]
        assert may in (None, folder)
        may = folder
    assert len(fact(w)) > 26  # multiplied
    w.vacuum()
    before = fact(w)
    again = Warehouse(spark, root)
    again.build("B9", at("2020-06-02"), rerate=True)
    assert fact(again) == before


def test_old_sales_keep_their_rate_without_rerating(spark, sources, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    for k, rate in enumerate((5.0, 6.0)):
        given = sources(tickets(spark, 1, 8 + k)) | {"commission_agreements": conform(agreements(spark, (1, "R0", rate, "2019-01-01", None, 1 + k)), schemas.SOURCES["commission_agreements"])}
        w.load_tables(given, f"B{k}", at("2020-06-01"))
        w.build(f"B{k}", at("2020-06-01"))
    assert {str(r[7]) for r in fact(w) if r[2] == "R0"} == {"5.00"}
    w.build("B2", at("2020-06-01"), rerate=True)
    assert {str(r[7]) for r in fact(w) if r[2] == "R0"} == {"6.00"}
