from decimal import Decimal
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from turnstile.fixed import DROP_HEADERS, FILE_NAME_LOOSE
from turnstile.schemas import DAILY_SALES
from turnstile.sources import (
    DropFeed,
    Ledgers,
    VersionedTable,
    csv_scan,
    fingerprint,
    positional_drops,
    unseen_files,
)
from turnstile.schemas import MASTER_CSV
from turnstile.streaming import stream_drops

HEADER = ",".join(DROP_HEADERS)
GOOD = "DailySales_01052020_RES005.csv"


def line(i, tickets="2", total="10.50"):
    return f'{i},"Rock, Night",{tickets},{total},web,ann,lee,Office,2020-01-05'


@pytest.fixture
def run_ts(spark):
    return F.lit("2020-06-01 00:00:00").cast("timestamp_ntz")


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()

    def put(name, *lines, header=HEADER):
        (folder / name).write_text("\n".join([header, *lines]) + "\n")
        return str(folder)

    return put


def feed(spark, tmp_path, **options):
    ledgers = Ledgers(spark, str(tmp_path / "audit"))
    table = VersionedTable(spark, str(tmp_path / "daily"), DAILY_SALES)
    return DropFeed(spark, table, ledgers, **options)


def test_master_csv_quoted_commas(spark, tmp_path):
    (tmp_path / "o.csv").write_text('organizer_id,organizer_name,country,region\nORG001,"Wilson, ""W"" and Co",USA,California\n')
    df = csv_scan(spark, str(tmp_path / "o.csv"), MASTER_CSV["organizers"])
    assert rows(df) == [("ORG001", 'Wilson, "W" and Co', "USA", "California")]


def test_fingerprint_follows_content_order_and_size(spark, inbox):
    folder = inbox(GOOD, line(1), line(2))
    inbox("notes.txt", "x")
    inbox("DailySales_01062020_RES006.CSV", line(2), line(1))
    inbox("DailySales_01072020_RES007.csv", line(1), line(2))
    (Path(folder) / "DailySales_01082020_RES008.csv").write_text("")
    found = {r.file_name: r for r in fingerprint(spark, folder).collect()}
    assert len(found) == 4 and found[GOOD].header == HEADER
    same, swapped, empty = (found[f"DailySales_010{n}2020_RES00{n}.{e}"] for n, e in ((7, "csv"), (6, "CSV"), (8, "csv")))
    assert found[GOOD].file_sha == same.file_sha != swapped.file_sha
    assert empty.header is None and empty.file_size == 0 and len(empty.file_sha) == 40


def test_a_known_inbox_is_not_opened_again(spark, tmp_path, inbox, run_ts, monkeypatch):
    """Only files that are new, or of another size or time, are read for their hash."""
    from turnstile.sources import drops

    opened = []
    real = drops.fingerprint
    monkeypatch.setattr(drops, "fingerprint", lambda s, f, paths=None: opened.append(sorted(Path(p).name for p in paths)) or real(s, f, paths))
    folder = inbox(GOOD, line(1))
    other = inbox("DailySales_01062020_RES006.csv", line(2)) and "DailySales_01062020_RES006.csv"
    assert feed(spark, tmp_path).load(folder, "B1", run_ts)["rows"] == 2
    assert opened.pop() == sorted([GOOD, other]) and not opened
    assert feed(spark, tmp_path).load(folder, "B2", run_ts) == {"files": 0, "failed": 0, "rows": 0, "rejected": 0}
    assert opened == []
    # Touched without a change: hashed once more, and not loaded. Changed: hashed and loaded.
    import os

    os.utime(Path(folder) / GOOD, (1, 1))
    inbox(other, line(2), line(3))
    assert feed(spark, tmp_path).load(folder, "B3", run_ts)["rows"] == 2
    assert opened == [sorted([GOOD, other])]
    assert feed(spark, tmp_path).load(folder, "B4", run_ts)["files"] == 0 and len(opened) == 1
    # A table that has lost its files loads them without reading them for their hash.
    again = feed(spark, tmp_path)
    again.table.truncate()
    assert again.load(folder, "B5", run_ts)["rows"] == 3 and len(opened) == 1


def test_fingerprint_does_not_depend_on_how_a_file_is_cut(spark, inbox):
    folder = inbox(GOOD, *[line(i) for i in range(2000)])
    whole = fingerprint(spark, folder).first().file_sha
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7001")
    try:
        assert fingerprint(spark, folder).first().file_sha == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_unseen_by_name_or_by_content(frame):
    files = frame("file_name string, file_sha string", ("a", "1"), ("b", "2"), ("c", "3"), ("d", "1"))
    history = frame(
        "file_name string, file_sha string, status string",
        ("a", "1", "SUCCESS"), ("b", "0", "SUCCESS"), ("c", "3", "FAILED"),
    )
    names = lambda df: [r[0] for r in rows(df)]
    assert names(unseen_files(files, history)) == ["b", "c", "d"]
    assert names(unseen_files(files, history, by_name=False)) == ["b", "c"]


def test_load_isolates_files_and_rejects_rows(spark, tmp_path, inbox, run_ts):
    folder = inbox(GOOD, line(1), line(2, tickets="many"), "3,too,few", line(4) + ",extra", ",no id,1,1,web,a,b,c,2020-01-01")
    inbox("Sales_01052020_RES005.csv", line(5))
    # Other column order, one column missing, one unknown.
    inbox("dailysales_01062020_res006.csv", "7,x,web,Jazz", header="Transaction ID,Ignored,Sales channel,Event name")
    f = feed(spark, tmp_path)
    assert f.load(folder, "B1", run_ts) == {"files": 2, "failed": 1, "rows": 2, "rejected": 4}
    loaded = f.table.read().select("transaction_id", "reseller_id", "event_name", "total_amount", "sales_channel", "batch_id")
    assert rows(loaded) == [
        (Decimal(1), "RES005", "Rock, Night", Decimal("10.50"), "web", "B1"),
        (Decimal(7), "res006", "Jazz", None, "web", "B1"),
    ]
    reasons = f.ledgers.rejects.read().groupBy("reason").count()
    assert rows(reasons) == [("bad number_of_purchased_tickets", 1), ("malformed line", 2), ("missing transaction_id", 1)]
    history = f.ledgers.files.read().select("file_name", "record_count", "status", "error_message")
    assert rows(history) == [
        (GOOD, 1, "SUCCESS", None),
        ("Sales_01052020_RES005.csv", 0, "FAILED", "Invalid file name: Sales_01052020_RES005.csv"),
        ("dailysales_01062020_res006.csv", 1, "SUCCESS", None),
    ]


def test_unusable_files_fail_alone(spark, tmp_path, inbox, run_ts):
    folder = inbox(GOOD, line(1))
    put = lambda n, text: (Path(folder) / f"DailySales_010{n}2020_RES00{n}.csv").write_text(text)
    put(1, "")
    put(2, f"\n{HEADER}\n{line(2)}\n")
    put(3, f"Transaction ID,Transaction ID\n1,2\n")
    put(4, "a,b\n1,2\n")
    f = feed(spark, tmp_path)
    assert f.load(folder, "B1", run_ts) == {"files": 1, "failed": 4, "rows": 1, "rejected": 0}
    bad = f.ledgers.files.read().where("status = 'FAILED'").select("error_message")
    assert [r[0] for r in rows(bad)] == ["Blank header line", "Empty file", "No known column", "Repeated column: Transaction ID"]


def test_quoted_line_breaks_are_kept(spark, tmp_path, inbox, run_ts):
    f = feed(spark, tmp_path)
    f.load(inbox(GOOD, line(1).replace("Rock, Night", "Rock\nNight")), "B1", run_ts)
    assert [r.event_name for r in f.table.read().collect()] == ["Rock\nNight"]


def test_equal_files_of_one_run_load_once(spark, tmp_path, inbox, run_ts):
    folder = inbox(GOOD, line(1))
    inbox("DailySales_01062020_RES006.csv", line(1))
    f = feed(spark, tmp_path, by_name=False, log_skipped=True)
    assert f.load(folder, "B1", run_ts)["rows"] == 1
    history = f.ledgers.files.read().select("file_name", "status")
    assert rows(history) == [(GOOD, "SUCCESS"), ("DailySales_01062020_RES006.csv", "SKIPPED")]


def test_a_run_that_dies_before_the_ledger_is_not_repeated(spark, tmp_path, inbox, run_ts, monkeypatch):
    folder = inbox(GOOD, line(1), line(2, tickets="many"))
    f = feed(spark, tmp_path)

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(type(f.ledgers.files), "append", die)
    with pytest.raises(RuntimeError):
        f.load(folder, "B1", run_ts)
    monkeypatch.undo()
    again = feed(spark, tmp_path)
    assert again.load(folder, "B1", run_ts)["files"] == 0
    assert again.table.read().count() == 1
    history = again.ledgers.files.read().select("file_name", "record_count", "status")
    assert rows(history) == [(GOOD, 1, "SUCCESS")]


def test_emptying_the_table_forgets_its_files(spark, tmp_path, inbox, run_ts):
    folder = inbox(GOOD, line(1))
    f = feed(spark, tmp_path)
    f.load(folder, "B1", run_ts)
    f.table.truncate()
    assert f.load(folder, "B2", run_ts)["rows"] == 1 and f.table.read().count() == 1


def test_second_run_loads_only_changes(spark, tmp_path, inbox, run_ts):
    folder = inbox(GOOD, line(1))
    f = feed(spark, tmp_path)
    f.load(folder, "B1", run_ts)
    assert f.load(folder, "B2", run_ts) == {"files": 0, "failed": 0, "rows": 0, "rejected": 0}
    inbox(GOOD, line(1), line(2))  # same name, new content: loaded again
    assert f.load(folder, "B3", run_ts)["rows"] == 2
    assert [int(r[0]) for r in rows(f.table.read())] == [1, 1, 2]


def test_known_content_under_another_name(spark, tmp_path, inbox, run_ts):
    folder = inbox(GOOD, line(1))
    f = feed(spark, tmp_path, by_name=False, log_skipped=True)
    f.load(folder, "B1", run_ts)
    inbox("DailySales_01062020_RES006.csv", line(1))
    assert f.load(folder, "B2", run_ts)["files"] == 0
    history = f.ledgers.files.read().select("file_name", "status", "record_count")
    assert rows(history) == [
        ("DailySales_01052020_RES005.csv", "SKIPPED", 0),
        ("DailySales_01052020_RES005.csv", "SUCCESS", 1),
        ("DailySales_01062020_RES006.csv", "SKIPPED", 0),
    ]


def test_fail_file_option_and_loose_names(spark, tmp_path, inbox, run_ts):
    folder = inbox(GOOD, line(1), line(2, total="?"))
    inbox("DailySales_02002020_RES010.csv", line(3))
    f = feed(spark, tmp_path, on_bad_rows="fail_file", pattern=FILE_NAME_LOOSE, dated=False)
    assert f.load(folder, "B1", run_ts)["rows"] == 1
    history = f.ledgers.files.read().select("file_name", "status", "error_message")
    assert rows(history) == [
        (GOOD, "FAILED", "bad total_amount"),
        ("DailySales_02002020_RES010.csv", "SUCCESS", None),
    ]


def test_positional_layout(spark, tmp_path, run_ts):
    header = (
        "sale_date,reseller_id,reseller_name,reseller_region,event_id,event_name,event_type,"
        "ticket_type_id,ticket_name,sales_channel,quantity,unit_price,gross_amount,"
        "commission_rate,customer_email,currency"
    )
    ok = "2020-02-01,R001,Northwind Tickets,Europe,1001,Summit,Conference,5001,VIP,WEB,2,150.00,300.00,10.00,c@example.com,USD"
    (tmp_path / "DailySales_02012020_R001.csv").write_text(f"{header}\n{ok}\n{ok.replace(',2,150', ',two,150')}\nshort\n")
    good, bad = positional_drops(spark, str(tmp_path), "B1", run_ts)
    g = good.first()
    assert (g.quantity, g.gross_amount, str(g.file_sale_date), g.file_name) == (
        2, Decimal("300.00"), "2020-02-01", "DailySales_02012020_R001.csv"
    )
    # The verdict on a row does not depend on the columns asked for.
    assert good.count() == 1 and good.select("reseller_id").count() == 1
    assert rows(bad.select("reason")) == [("bad quantity",), ("malformed line",)]


def test_stream_reads_each_file_once(spark, tmp_path, inbox, run_ts):
    folder = inbox(GOOD, line(1), line(2, tickets="many"))
    inbox("Sales_01052020_RES005.csv", line(5))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: stream_drops(spark, folder, out, state, run_ts).awaitTermination()
    run()
    run()
    inbox("DailySales_01062020_RES006.csv", line(6))
    run()
    read = lambda part: spark.read.parquet(f"{out}/{part}/epoch=*")
    assert [(int(r[0]), r[1]) for r in rows(read("rows"))] == [(1, "RES005"), (6, "RES006")]
    assert rows(read("rejects").select("reason")) == [("bad number_of_purchased_tickets",), ("invalid file name",)]
    assert rows(read("files")) == [("DailySales_01052020_RES005.csv", 1), ("DailySales_01062020_RES006.csv", 1)]


def test_stream_loads_a_transaction_once(spark, tmp_path, inbox, run_ts):
    """A file sent again under another name, rows repeated in one batch and in later ones; a mended row comes."""
    folder = inbox(GOOD, line(1), line(2), line(3, tickets="many"), line(3, tickets="many"))
    inbox("DailySales_01062020_RES006.csv", line(2), line(4))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    ledgers = Ledgers(spark, str(tmp_path / "audit"))
    run = lambda: stream_drops(spark, folder, out, state, run_ts, ledgers=ledgers).awaitTermination()
    loaded = lambda: sorted(int(r.transaction_id) for r in spark.read.parquet(f"{out}/rows/epoch=*").collect())
    run()
    assert loaded() == [1, 2, 4]
    inbox("DailySales_01072020_RES005.csv", line(1), line(2))
    inbox("DailySales_01082020_RES005.csv", line(3), line(4), line(9))
    inbox("Other.csv", line(10))
    run()
    run()
    assert loaded() == [1, 2, 3, 4, 9]
    assert spark.read.parquet(f"{out}/rejects/epoch=*").where("reason = 'bad number_of_purchased_tickets'").count() == 1
    history = {r.file_name: (r.status, r.record_count, len(r.file_sha)) for r in ledgers.files.read().collect()}
    both = history.pop(GOOD)[1] + history.pop("DailySales_01062020_RES006.csv")[1]
    assert both == 3 and history == {"DailySales_01082020_RES005.csv": ("SUCCESS", 2, 40), "Other.csv": ("FAILED", 0, 40)}


def test_a_replayed_epoch_leaves_the_same_rows_and_ledger(spark, tmp_path, inbox, run_ts, monkeypatch):
    folder = inbox(GOOD, line(1), line(2))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    ledgers = Ledgers(spark, str(tmp_path / "audit"))
    real = type(ledgers.files).append

    def dies(self, df):
        real(self, df)
        raise RuntimeError("lost after the ledger")

    monkeypatch.setattr(type(ledgers.files), "append", dies)
    with pytest.raises(Exception, match="lost after"):
        stream_drops(spark, folder, out, state, run_ts, ledgers=ledgers).awaitTermination()
    monkeypatch.undo()
    later = F.lit("2020-07-01 00:00:00").cast("timestamp_ntz")
    stream_drops(spark, folder, out, state, later, ledgers=ledgers).awaitTermination()
    assert spark.read.parquet(f"{out}/rows/epoch=*").count() == 2
    assert [(r.file_name, r.record_count) for r in ledgers.files.read().collect()] == [(GOOD, 2)]
