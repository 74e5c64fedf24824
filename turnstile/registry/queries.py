"""One query per operator, over the whole given tables.

Names start with the operator's id. Results are shown with numbers as bigint or
double and dates as text, so that two engines can be compared value by value.
"""

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from .. import schemas
from ..fixed import CHANNELS, DROP_HEADERS, FILE_NAME_LOOSE, SYSTEM_FILES
from ..operators import (
    add_missing_columns,
    apply_upsert,
    coerce_timestamps,
    conform,
    date_range,
    duplicate_keys,
    filtered_totals,
    high_water_mark,
    incremental_rows,
    interval_join,
    latest_by,
    lookup_join,
    merge_match,
    merge_state,
    multiplied_rows,
    name_join,
    orphan_count,
    orphan_rows,
    overlapping_periods,
    reconcile,
    rename_columns,
    stamp,
    top_k,
    totals,
    unrelated_pairs,
    upsert_by_hash,
)
from ..operators.checks import (
    ChecksFailed,
    accepted,
    assert_checks,
    bad_rows,
    not_null,
    related,
    run_checks,
    unique,
)
from ..operators.joins import part_of, parts_of
from ..plans import quality, reports, staging, star
from ..plans.standing import StandingChecks
from ..plans.summaries import DailySums
from ..plans.sales import platform_sales, unified_sales, vendor_sales
from ..plans.warehouse import Warehouse
from ..session import scratch_dir
from ..sources import (
    Commits,
    DropFeed,
    Ledgers,
    Parted,
    VersionedTable,
    append_rows,
    commit_together,
    csv_scan,
    fingerprint,
    incremental_scan,
    land,
    load_by_name,
    positional_drops,
    unseen_files,
)
from ..sources.drops import DROP_TEXT
from ..sources.ledgers import current_watermarks, new_watermarks
from ..sources.tables import months
from ..streaming import stream_drops
from .domain import Domain, Lazy, ts
from .exports import daily_with_headers, export_drops, export_positional

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
RUN = "2024-03-01 00:00:00"


def shown(df: DataFrame) -> DataFrame:
    """Numbers as bigint or double, dates and times as text."""

    def column(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.NumericType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType | T.TimestampType | T.TimestampNTZType):
            c = c.cast("string")
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema])


def query(name: str):
    """Register a function of a ``Domain`` under a name."""

    def register(build: Callable[[Domain], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return shown(build(Domain(spark, folder)))

        _QUERIES[name] = run
        return build

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


# -- shared pieces ---------------------------------------------------------


def staged(d: Domain) -> Lazy:
    raw = d.raw()
    return Lazy(
        {n: lambda n=n, stage=stage: stage(raw[n]) for n, stage in staging.STAGING.items()}
    )


def sales(d: Domain) -> DataFrame:
    return unified_sales(staged(d))


def fact(d: Domain) -> DataFrame:
    s = staged(d)
    return star.fact_ticket_sales(unified_sales(s, columns=star.FACT_INPUT), s["commission_agreements"])


def _platform_sales(d: Domain) -> DataFrame:
    s = staged(d)
    return platform_sales(s["ticket_sales"], s["events"], s["customers"], s["resellers"], columns=star.FACT_INPUT)


def _landed(d: Domain, df: DataFrame, name: str) -> DataFrame:
    """Rows that several steps read, worked out and written once."""
    folder = scratch_dir(d.spark, name)
    land(df, folder)
    return d.spark.read.schema(df.schema).parquet(folder)


def _dims(s: Lazy) -> dict[str, Callable[[], DataFrame]]:
    return {
        "dim_customer": lambda: star.dim_customer(s["customers"]),
        "dim_organizer": lambda: star.dim_organizer(s["organizers"]),
        "dim_reseller": lambda: star.dim_reseller(s["resellers"]),
        "dim_event": lambda: star.dim_event(s["events"], s["organizers"]),
    }


def dims(d: Domain) -> Lazy:
    return Lazy(_dims(staged(d)))


def _sales_asked(wanted: set[str], checks: list) -> list[str]:
    """Columns of the unified sales that the checks, the fact or the dates take."""
    own = [c for c in checks if "int_sales_transactions" in (c.table, c.parent)]
    asked = {n for c in own for n in (*c.columns, *c.parent_columns, c.key, *re.findall(r"\w+", c.condition))}
    if "fact_ticket_sales" in wanted:
        asked |= set(star.FACT_INPUT)
    if "dim_date" in wanted:
        asked.add("sales_date")
    return [c for c in schemas.SALES_COLUMNS if c in asked]


def models(d: Domain, checks: list) -> dict[str, DataFrame]:
    """The models that the checks name. As in the warehouse, unified sales and the fact
    are written once and read back by whatever follows; only if a check needs them, and
    only the columns that are asked for."""
    wanted = {c.table for c in checks} | {c.parent for c in checks if c.parent}
    s = staged(d)
    root = scratch_dir(d.spark, "models")
    named = {f"stg_{n}".replace("stg_commission_agreements", "stg_commissions"): n for n in staging.STAGING}
    found = {m: s[n] for m, n in named.items() if m in wanted}
    build = {n: b for n, b in _dims(s).items() if n in wanted}
    found |= {n: b() for n, b in build.items()}
    later = wanted - found.keys()
    if later:
        unified = unified_sales(s, columns=_sales_asked(wanted, checks))
        stored = VersionedTable(d.spark, f"{root}/sales", unified.schema)
        stored.publish(unified)
        found["int_sales_transactions"] = stored.read()
        if "dim_date" in wanted:
            found["dim_date"] = star.dim_date(stored.read())
        if "fact_ticket_sales" in wanted:
            facts = VersionedTable(d.spark, f"{root}/fact", schemas.FACT)
            facts.publish(star.fact_ticket_sales(stored.read(), s["commission_agreements"]))
            found["fact_ticket_sales"] = facts.read()
    return found


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def orders_as_rows(d: Domain, where: str) -> DataFrame:
    """Orders with money as decimals and the order date as change time."""
    return d("orders").where(where).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        money("o_totalprice").alias("o_totalprice"),
        F.col("o_orderdate").alias("updated_at"),
    )


# -- scans, sources, sinks -------------------------------------------------


@query("s01_csv_scan")
def _(d):
    folder = scratch_dir(d.spark, "csv")
    fields = schemas.MASTER_CSV["customers"]
    (
        d.customers().select(*fields.fieldNames())
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return csv_scan(d.spark, folder, fields)


@query("s02_reseller_csv_scan")
def _(d):
    return fingerprint(d.spark, export_drops(d.spark, d.folder)).select("file_name", "header")


@query("s02_reseller_csv_rows")
def _(d):
    """Every row of every drop file, as read, in all columns."""
    rows = csv_scan(d.spark, export_drops(d.spark, d.folder), T.StructType([T.StructField(h, T.StringType()) for h in DROP_HEADERS]))
    return rows.toDF(*DROP_HEADERS.values()).withColumn("file_name", F.col("_metadata.file_name"))


@query("s03_file_fingerprint")
def _(d):
    files = fingerprint(d.spark, export_drops(d.spark, d.folder))
    return files.agg(
        F.count("*").alias("files"),
        F.countDistinct("file_sha").alias("hashes"),
        F.max(F.length("file_sha")).alias("hash_length"),
    )


@query("s04_positional_scan")
def _(d):
    good, _ = positional_drops(
        d.spark, export_positional(d.spark, d.folder), "BATCH_3", ts(RUN)
    )
    return good


@query("s05_parquet_sink")
def _(d):
    seen = land(d.ticket_sales(), scratch_dir(d.spark, "landing"))
    return d.spark.range(1).select(
        F.lit(seen["rows"]).alias("rows"), F.lit(seen["mark"]).cast("timestamp_ntz").alias("mark")
    )


@query("s06_parquet_load_by_name")
def _(d):
    folder = scratch_dir(d.spark, "landing")
    raw = d.customers()
    raw.select(*[F.col(c).alias(c.upper()) for c in reversed(raw.columns)]).write.parquet(folder)
    return load_by_name(d.spark, folder, schemas.RAW["customers"])


@query("s07_table_scan")
def _(d):
    rows = orders_as_rows(d, "true")
    t = VersionedTable(d.spark, scratch_dir(d.spark, "table"), rows.schema, months("updated_at"))
    t.publish(rows)
    return t.read()


@query("s08_incremental_scan")
def _(d):
    return incremental_scan(orders_as_rows(d, "true"), ts("1998-01-01 00:00:00"))


@query("s09_append_sink")
def _(d):
    folder = scratch_dir(d.spark, "append")
    first = append_rows(orders_as_rows(d, "o_orderstatus = 'F'"), folder)
    second = append_rows(orders_as_rows(d, "o_orderstatus <> 'F'"), folder)
    stored = d.spark.read.parquet(folder)
    return stored.agg(F.count("*").alias("stored")).select(
        F.lit(first).alias("first"), F.lit(second).alias("second"), "stored"
    )


@query("s11_truncate")
def _(d):
    rows = orders_as_rows(d, "true")
    t = VersionedTable(d.spark, scratch_dir(d.spark, "table"), rows.schema)
    t.publish(rows)
    before = t.row_count()
    t.truncate()
    return t.read().agg(F.count("*").alias("rows_after")).select(
        F.lit(before).alias("rows_before"), "rows_after", t.high_mark().alias("mark")
    )


@query("s12_materialize")
def _(d):
    dates = star.dim_date(sales(d))
    t = VersionedTable(d.spark, scratch_dir(d.spark, "dim_date"), dates.schema)
    t.publish(dates)
    return t.read()


# -- projections, cleansing, filters ---------------------------------------


@query("p01_rename_columns")
def _(d):
    return rename_columns(daily_with_headers(d), DROP_HEADERS)


@query("p02_add_missing_columns")
def _(d):
    partial = rename_columns(daily_with_headers(d), DROP_HEADERS).drop("office_location")
    return add_missing_columns(partial, DROP_TEXT)


@query("p03_conform")
def _(d):
    return conform(
        rename_columns(daily_with_headers(d), DROP_HEADERS).withColumn("Extra", F.lit(1)),
        schemas.DAILY_SALES,
    )


@query("p04_stamp_metadata")
def _(d):
    bare = d("customer").select("c_custkey", "c_name")
    return stamp(
        bare, "BATCH_9", SYSTEM_FILES, ts(RUN), source_file=F.lit("f.csv"),
        reseller=fn.drop_file_reseller(F.lit("DailySales_01052020_RES005.csv")),
    )


@query("p05_coerce_timestamps")
def _(d):
    dated = d.events().select("event_id", "event_date")
    return coerce_timestamps(dated, ["EVENT_DATE", "ABSENT"])


@query("p06_stg_customers")
def _(d):
    return staging.stg_customers(d.customers())


@query("p07_stg_events")
def _(d):
    return staging.stg_events(d.events())


@query("p08_stg_organizers")
def _(d):
    return staging.stg_organizers(d.organizers())


@query("p09_stg_resellers")
def _(d):
    return staging.stg_resellers(d.resellers())


@query("p10_stg_commissions")
def _(d):
    return staging.stg_commissions(d.commission_agreements())


@query("p11_stg_reseller_daily_sales")
def _(d):
    return staging.stg_reseller_daily_sales(d.reseller_daily_sales())


@query("p12_stg_ticket_sales")
def _(d):
    return staging.stg_ticket_sales(d.ticket_sales())


@query("p13_literal_columns")
def _(d):
    s = staged(d)
    return vendor_sales(s["reseller_daily_sales"], s["events"], s["resellers"]).select(
        "sales_id", "sales_source", "ticket_id", "customer_id", "seller_id", "seller_type"
    )


@query("p14_coalesce_measures")
def _(d):
    return fact(d).select("sales_key", "quantity", "unit_price", "total_amount", "commission_rate")


@query("p15_commission_amount")
def _(d):
    line = d("lineitem").select(
        "l_orderkey", "l_linenumber", money("l_extendedprice").alias("total"),
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("rate"),
    )
    return line.withColumn("commission_amount", fn.commission("total", "rate"))


@query("p16_comparison_filters")
def _(d):
    t = staging.stg_ticket_sales(d.ticket_sales())
    return t.where(
        (F.col("quantity") <= 0) | (F.col("total_amount") < 0)
        | ((F.col("quantity") > 49) & (F.col("sales_channel") != "WEB")
           & (F.col("purchase_date") >= F.lit("2000-01-01").cast("date")))
    ).select("ticket_id", "quantity", "total_amount", "sales_channel")


@query("p17_null_filters")
def _(d):
    t = staging.stg_ticket_sales(d.ticket_sales())
    direct = t.where(F.col("reseller_id").isNull())
    resold = t.where(F.col("reseller_id").isNotNull())
    return union(
        direct.select(F.lit("direct").alias("kind"), "ticket_id"),
        resold.select(F.lit("resold").alias("kind"), "ticket_id"),
    )


@query("p18_range_or_null")
def _(d):
    c = F.col("commission_rate")
    rates = staging.stg_commissions(d.commission_agreements())
    return rates.where((c < 0) | (c > 100) | c.isNull()).select(
        "agreement_id", "organizer_id", "reseller_id", "commission_rate"
    )


@query("p19_not_in_list")
def _(d):
    t = staging.stg_ticket_sales(d.ticket_sales())
    c = F.col("sales_channel")
    return t.where(~c.isin(CHANNELS) | c.isNull()).select("ticket_id", "sales_channel")


@query("p20_column_subset")
def _(d):
    return d("lineitem").select("l_orderkey", F.col("l_suppkey").alias("seller"))


# -- scalar functions ------------------------------------------------------


@query("f01_f04_clean_text")
def _(d):
    p = d("part")
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    blank = F.when(F.col("p_type") == "PROMO", " ").otherwise(F.col("p_type"))
    return p.select(
        "p_partkey",
        fn.clean(padded).alias("trimmed"),
        fn.upper_clean(padded).alias("upper_name"),
        fn.lower_clean("p_brand").alias("lower_brand"),
        fn.blank_to_null(blank).alias("kind"),
        F.nullif(F.col("p_size"), F.lit(10)).alias("size"),
    )


@query("f05_initcap")
def _(d):
    text = F.concat_ws("-", "p_name", "p_type", "p_brand")
    return d("part").select("p_partkey", fn.initcap_wide(text).alias("name"))


@query("f06_f10_casts")
def _(d):
    e = d.events()
    price = F.col("p_retailprice").cast("decimal(12,4)").cast("string")
    # Whole dates, parts of dates, and dates with more text behind them.
    forms = F.expr(
        """stack(6, 'whole', event_date, 'timed', event_date || ' 10:20:30',
             'year', left(event_date, 4), 'month', left(event_date, 7),
             'more', event_date || ' garbage', 'letter', event_date || 'Tx')"""
    ).alias("form", "text")
    dates = e.select("event_id", forms).select(
        "event_id", "form", F.col("text").alias("event_date"),
        fn.try_date("text").alias("event_day"),
    )
    keyed = dates.withColumn(
        "known_day", F.coalesce("event_day", F.lit("2999-12-31").cast("date"))
    )
    numbers = d("part").select(
        F.concat(F.lit("EVT"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("event_id"),
        fn.try_number(price, 5, 2).alias("small_price"),
        fn.try_number("p_name").alias("no_number"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
    )
    return keyed.join(numbers, "event_id").withColumn(
        "day_ts", F.col("event_day").cast("timestamp_ntz")
    )


@query("f11_f13_date_parts")
def _(d):
    o = d("orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return o.select(
        "o_orderkey",
        *[c.alias(n) for n, c in fn.date_parts("day").items()],
        fn.week_start("day").alias("week_start"),
    )


@query("f14_f15_decimal_arithmetic")
def _(d):
    price, part = money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)")
    whole = d("lineitem").select(
        "l_orderkey", "l_linenumber",
        F.round(price * (F.lit(1).cast("decimal(4,2)") - part), 2).alias("net"),
        (price + price).alias("twice"),
        fn.unit_price(price, F.col("l_quantity").cast("decimal(10,0)")).alias("unit_price"),
    )
    return whole


@query("f16_f17_as_of_and_run_time")
def _(d):
    day = F.col("o_orderdate").cast("date")
    later = d("orders").where(fn.future(day, F.lit("2000-01-01").cast("date")))
    return later.select("o_orderkey", ts(RUN).alias("checked_at"))


@query("f18_surrogate_key")
def _(d):
    empty = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return d("lineitem").select(
        fn.surrogate_key("l_orderkey", "l_linenumber", empty).alias("sales_key")
    )


def _file_names(d):
    """Names of every kind: good, foreign reseller, impossible day, trailing junk."""
    day = F.date_format("ts", "MMddyyyy")
    return d("events").select(
        "event_id",
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("DailySales_"), day, F.lit("_RES"), "user_id", F.lit(".csv")))
        .when(F.col("event_type") == "click", F.concat(F.lit("dailysales_"), day, F.lit("_res"), "user_id", F.lit(".CSV")))
        .when(F.col("event_type") == "view", F.concat(F.lit("DailySales_"), day, F.lit("_R"), "user_id", F.lit(".csv")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("DailySales_02002020_RES"), "user_id", F.lit(".csv")))
        .otherwise(F.concat(F.lit("DailySales_"), day, F.lit("_RES"), "user_id", F.lit(".csv.bak")))
        .alias("file_name"),
    )


@query("f19_loose_file_name")
def _(d):
    return _file_names(d).withColumn(
        "reseller_id", fn.drop_file_reseller("file_name", FILE_NAME_LOOSE)
    )


@query("f20_strict_file_name")
def _(d):
    return _file_names(d).select(
        "event_id", "file_name",
        fn.drop_file_date("file_name").alias("sale_date"),
        fn.drop_file_reseller("file_name").alias("reseller_id"),
    )


@query("f22_to_date")
def _(d):
    text = F.date_format("o_orderdate", "MMddyyyy")
    return d("orders").select("o_orderkey", fn.try_date(text, "MMddyyyy").alias("day"))


@query("f23_table_from_file")
def _(d):
    return _file_names(d).withColumn("table_name", fn.table_from_file("file_name"))


@query("f24_divide")
def _(d):
    return d("events").select(
        "event_id",
        fn.safe_divide(F.col("value"), F.expr("event_id % 7")).alias("share"),
    )


# -- joins -----------------------------------------------------------------


@query("j01_event_by_name")
def _(d):
    s = staged(d)
    ref = s["events"].select("event_id", "organizer_id", F.col("event_name").alias("known"))
    return name_join(
        s["reseller_daily_sales"], ref, "event_name", "known", ["transaction_id"]
    ).select("transaction_id", "event_name", "event_id", "organizer_id")


@query("j02_sale_reseller")
def _(d):
    s = staged(d)
    return lookup_join(
        s["ticket_sales"].select("ticket_id", "reseller_id"),
        s["resellers"].select("reseller_id", "reseller_name"),
        {"reseller_id": "reseller_id"}, spread=["ticket_id"],
    )


@query("j03_sale_event")
def _(d):
    s = staged(d)
    return lookup_join(
        s["ticket_sales"].select("ticket_id", "event_id"),
        s["events"].select("event_id", "event_name", "organizer_id"),
        {"event_id": "event_id"}, spread=["ticket_id"],
    )


@query("j04_sale_customer")
def _(d):
    s = staged(d)
    return lookup_join(
        s["ticket_sales"].select("ticket_id", "customer_id"),
        s["customers"].select("customer_id", "first_name", "last_name"),
        {"customer_id": "customer_id"}, spread=["ticket_id"],
    )


@query("j05_effective_commission")
def _(d):
    s = staged(d)
    rated = star.rated_sales(
        unified_sales(s).select(
            "sales_id", "organizer_id", "reseller_id", "sales_date", "total_amount"
        ),
        s["commission_agreements"],
    )
    return rated.withColumn("commission_amount", fn.commission("total_amount", "commission_rate"))


@query("j06_event_organizer")
def _(d):
    s = staged(d)
    return lookup_join(
        s["events"].select("event_id", "organizer_id"),
        s["organizers"].select("organizer_id", "organizer_name"),
        {"organizer_id": "organizer_id"}, spread=["event_id"],
    )


@query("j07_orphan_counts")
def _(d):
    s = staged(d)
    pairs = [
        ("events", "organizers", "organizer_id"),
        ("commission_agreements", "organizers", "organizer_id"),
        ("commission_agreements", "resellers", "reseller_id"),
        ("ticket_sales", "events", "event_id"),
        ("ticket_sales", "customers", "customer_id"),
        ("ticket_sales", "resellers", "reseller_id"),
    ]
    return union(
        *[
            orphan_count(s[c], s[p], {k: k}).select(
                F.lit(f"{c} -> {p}").alias("reference"), "orphans"
            )
            for c, p, k in pairs
        ]
    )


@query("j08_orphan_rows")
def _(d):
    s = staged(d)
    return orphan_rows(
        s["ticket_sales"].select("ticket_id", "reseller_id"), s["resellers"],
        {"reseller_id": "reseller_id"}, spread=["ticket_id"],
    )


@query("j09_not_member")
def _(d):
    s = staged(d)
    return lookup_join(
        s["ticket_sales"].select("ticket_id", "reseller_id"), s["resellers"],
        {"reseller_id": "reseller_id"}, "left_anti", spread=["ticket_id"],
    )


def _sale_pairs(d):
    """Sales counted per organizer of the event and reseller, without agreement."""
    s = staged(d)
    return unrelated_pairs(
        s["ticket_sales"], s["events"], "event_id", "organizer_id", "reseller_id",
        s["commission_agreements"],
    )


@query("j10_sales_without_agreement")
def _(d):
    return _sale_pairs(d).agg(F.sum("n").alias("sales_without_commission_agreement"))


@query("j11_pairs_without_agreement")
def _(d):
    return _sale_pairs(d).withColumnRenamed("n", "sales")


@query("j12_labelled_revenue")
def _(d):
    s = staged(d)
    per_key = totals(s["ticket_sales"], ["reseller_id"], {"revenue": F.sum("total_amount")})
    named = lookup_join(
        per_key, s["resellers"].select("reseller_id", "reseller_name"),
        {"reseller_id": "reseller_id"}, "inner",
    )
    return totals(named, ["reseller_name"], {"revenue": F.sum("revenue")})


def _stored_orders(d):
    return orders_as_rows(d, "o_orderstatus IN ('F', 'P')")


def _new_orders(d):
    """New state of open and partly shipped orders: higher price, moved date."""
    changed = orders_as_rows(d, "o_orderstatus IN ('O', 'P')")
    return changed.withColumns(
        {
            "o_totalprice": (F.col("o_totalprice") + 1).cast("decimal(18,2)"),
            "updated_at": F.expr(
                "updated_at + make_dt_interval(CAST(o_custkey % 3 AS INT) - 1)"
            ),
        }
    )


@query("j13_merge_match")
def _(d):
    met = merge_match(_stored_orders(d), _new_orders(d), ["o_orderkey"])
    return met.groupBy(merge_state().alias("state")).agg(F.count("*").alias("keys"))


@query("j05_many_periods")
def _(d):
    """Line items against orders as periods; one pair holds a third of either."""
    pair = lambda c: F.when(F.col(c) % 3 == 0, F.lit(0)).otherwise(F.col(c) % 50).cast("bigint").alias("pair")
    periods = d("orders").select(
        pair("o_custkey"), F.col("o_orderdate").cast("date").alias("effective_from"),
        F.expr("IF(o_orderkey % 97 = 0, NULL, date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 40 AS INT)))").alias("effective_to"),
        (F.col("o_orderkey") % 100).alias("rate"),
    )
    sold = d("lineitem").select(pair("l_partkey"), F.col("l_shipdate").cast("date").alias("day"))
    # Alike rows and alike periods are counted first: what is joined then grows with the
    # days and the lengths of periods, not with the product of rows and periods.
    sold = totals(sold, ["pair", "day"], {"n": F.count("*")})
    periods = totals(periods, ["pair", "effective_from", "effective_to"], {"periods": F.count("*"), "rated": F.count("rate"), "rate": F.sum("rate")})
    met = interval_join(sold, periods, ["pair"], "day")
    return totals(met, ["pair", F.year("day").alias("year")], {
        "rows": F.sum(F.col("n") * F.coalesce("periods", F.lit(1))),
        "matches": F.sum(F.col("n") * F.coalesce("rated", F.lit(0))),
        "rates": F.sum(F.col("n") * F.col("rate")),
    })


@query("j05_multiplied_sales")
def _(d):
    s = staged(d)
    agreed = star.current_agreements(s["commission_agreements"])
    return multiplied_rows(sales(d), agreed, ["organizer_id", "reseller_id"], "sales_date", ["sales_id", "sales_source"])


@query("w01_overlapping_agreements")
def _(d):
    agreed = star.current_agreements(staging.stg_commissions(d.commission_agreements()))
    return overlapping_periods(agreed, ["organizer_id", "reseller_id"]).drop("island")


# -- aggregates, window, order, union --------------------------------------


@query("a01_count")
def _(d):
    return d("lineitem").agg(F.count("*").alias("row_count"))


@query("a02_duplicate_keys")
def _(d):
    return duplicate_keys(d("lineitem"), ["l_orderkey", "l_linenumber"])


@query("a03_min_max_date")
def _(d):
    s = staged(d)
    first = date_range(s["events"], "event_date").select(
        F.lit("events").alias("table_name"),
        F.col("min_event_date").alias("first"), F.col("max_event_date").alias("last"),
    )
    second = date_range(s["ticket_sales"], "purchase_date").select(
        F.lit("ticket_sales").alias("table_name"),
        F.col("min_purchase_date").alias("first"), F.col("max_purchase_date").alias("last"),
    )
    return union(first, second)


@query("a04_high_water_mark")
def _(d):
    none = d.ticket_sales().where("updated_at < TIMESTAMP_NTZ'1900-01-01 00:00:00'")
    return union(
        high_water_mark(d.ticket_sales()).select(F.lit("all").alias("rows"), "updated_at"),
        high_water_mark(none).select(F.lit("none").alias("rows"), "updated_at"),
    )


@query("a05_totals_by_year")
def _(d):
    t = staging.stg_ticket_sales(d.ticket_sales())
    return reports.revenue_by_year(t)


@query("a06_amount_by_year")
def _(d):
    year = F.year("o_orderdate").alias("year")
    return totals(d("orders"), [year], {"total_amount": F.sum(money("o_totalprice"))})


@query("a07_sum_by_name")
def _(d):
    per_part = totals(
        d("lineitem"), ["l_partkey"], {"revenue": F.sum(money("l_extendedprice"))}
    )
    named = lookup_join(
        per_part, d("part").select("p_partkey", "p_name"), {"l_partkey": "p_partkey"}, "inner"
    )
    return totals(named, ["p_name"], {"revenue": F.sum("revenue")})


@query("a08_distinct_rows")
def _(d):
    return d("part").select("p_brand", "p_type").distinct()


@query("a09_is_unique")
def _(d):
    def test(name, df, key):
        counts = totals(df, [key], {"n": F.count("*")})
        return counts.agg(
            F.when(F.coalesce(F.max("n"), F.lit(0)) <= 1, "PASS").otherwise("FAIL").alias("status")
        ).select(F.lit(name).alias("check_name"), "status")

    direct = staging.stg_ticket_sales(d.ticket_sales())
    return union(
        test("orders", d("orders"), "o_orderkey"),
        test("lineitem", d("lineitem"), "l_orderkey"),
        test("ticket", direct, "ticket_id"),
        test("nullable", direct, "reseller_id"),
    )


@query("a10_filtered_totals")
def _(d):
    day = F.col("o_orderdate")

    def feb(y):
        return (F.year(day) == y) & (F.month(day) == 2)

    return filtered_totals(
        d("orders"), money("o_totalprice"), {"feb_2000": feb(2000), "feb_1999": feb(1999)}
    )


@query("a11_measures")
def _(d):
    return reports.measures(fact(d))


@query("a12_row_count_and_empty")
def _(d):
    t = d.ticket_sales()
    late = t.where("updated_at > TIMESTAMP_NTZ'2030-01-01 00:00:00'")
    return t.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit("yes" if t.isEmpty() else "no").alias("empty"),
        F.lit("yes" if late.isEmpty() else "no").alias("delta_empty"),
    )


@query("a13_conditional_counts")
def _(d):
    t = staging.stg_ticket_sales(d.ticket_sales())
    return t.agg(
        F.count_if(F.col("quantity") <= 0).alias("bad_quantity"),
        F.count_if(F.col("unit_price") <= 0).alias("bad_price"),
        F.count_if(~F.col("sales_channel").isin(CHANNELS) | F.col("sales_channel").isNull()).alias("bad_channel"),
        F.count_if(F.round(F.col("quantity") * F.col("unit_price"), 2) != F.col("total_amount")).alias("mismatch"),
    )


@query("w01_latest_version")
def _(d):
    return d.latest_lines()


@query("w01_current_agreements")
def _(d):
    return star.current_agreements(staging.stg_commissions(d.commission_agreements()))


@query("o01_top_by_revenue")
def _(d):
    line = d("lineitem").select("l_partkey", money("l_extendedprice").alias("amount"))
    part = d("part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return reports.top_by_revenue(line, part, "l_partkey", "p_name", 10, "amount")


@query("o02_order_by_group")
def _(d):
    return totals(
        d("orders"), [F.year("o_orderdate").alias("sales_year")], {"orders": F.count("*")}
    ).orderBy("sales_year")


@query("o04_existence")
def _(d):
    suppliers = d("supplier").select("s_suppkey", "s_name")
    seen = d("lineitem").where("l_returnflag = 'R'")
    return lookup_join(suppliers, seen, {"s_suppkey": "l_suppkey"}, "left_semi")


@query("u01_union_of_feeds")
def _(d):
    s = staged(d)
    vendor = vendor_sales(s["reseller_daily_sales"], s["events"], s["resellers"])
    platform = platform_sales(s["ticket_sales"], s["events"], s["customers"], s["resellers"])
    return vendor.unionByName(platform).select(
        "sales_id", "sales_source", "quantity", "unit_price", "total_amount", "sales_date"
    )


@query("u02_labelled_counts")
def _(d):
    return reports.row_counts({n: d(n) for n in ("nation", "supplier", "part", "orders", "lineitem")})


# -- incremental load, upsert, ledgers -------------------------------------

_CUT = "1999-01-01 00:00:00"


@query("i01_get_watermark")
def _(d):
    ledgers = Ledgers(d.spark, scratch_dir(d.spark, "audit"))
    rows = orders_as_rows(d, "true")
    for batch, until, run in (("B1", _CUT, RUN), ("B2", "2030-01-01 00:00:00", "2024-03-02 00:00:00")):
        loaded = rows.where(F.col("updated_at") < ts(until))
        ledgers.watermarks.append(new_watermarks("orders", loaded, batch, ts(run)))
    return d.spark.range(1).select(
        ledgers.watermark("orders").alias("orders"), ledgers.watermark("absent").alias("absent")
    )


@query("i02_update_watermark")
def _(d):
    ledgers = Ledgers(d.spark, scratch_dir(d.spark, "audit"))
    ledgers.set_watermark("customers", ts("1990-01-01 00:00:00"), "B0", ts("2024-01-01 00:00:00"))
    for name in ("organizers", "customers", "ticket_sales", "reseller_daily_sales"):
        ledgers.watermarks.append(new_watermarks(name, d.raw()[name], "B1", ts(RUN)))
    return current_watermarks(ledgers.watermarks.read())


@query("i03_incremental_staging")
def _(d):
    landed = scratch_dir(d.spark, "landing")
    land(d.ticket_sales(), landed)
    raw = d.spark.read.parquet(landed)
    first = staging.stg_ticket_sales(raw.where(F.col("updated_at") <= ts(_CUT)))
    t = VersionedTable(
        d.spark, scratch_dir(d.spark, "stg"), first.schema, months("purchase_date")
    )
    t.publish(first)
    t.upsert(staging.stg_ticket_sales(raw, mark=t.high_mark()), ["ticket_id"])
    return t.read()


@query("i04_upsert")
def _(d):
    return apply_upsert(_stored_orders(d), _new_orders(d), ["o_orderkey"])


@query("i04_upsert_guarded")
def _(d):
    return apply_upsert(_stored_orders(d), _new_orders(d), ["o_orderkey"], guard="updated_at")


@query("i04_upsert_versioned_table")
def _(d):
    stored = _stored_orders(d)
    t = VersionedTable(
        d.spark, scratch_dir(d.spark, "orders"), stored.schema, months("updated_at")
    )
    t.publish(stored)
    t.upsert(_new_orders(d), ["o_orderkey"], guard="updated_at")
    return t.read()


@query("i05_incremental_fact")
def _(d):
    sold = _landed(d, _platform_sales(d), "platform-sales")
    rated = lambda **since: star.fact_ticket_sales(sold, staged(d)["commission_agreements"], **since)
    target = _landed(d, rated().where(F.col("updated_at") <= ts(_CUT)), "target")
    delta = _landed(d, rated(target=target), "delta")
    return upsert_by_hash(target, delta, ["sales_key"])


def _stored_fact(d, rows, name="fact", commits=None, gathered=False):
    """A fact table by month with a directory of its keys."""
    root = scratch_dir(d.spark, name)
    record = commits or Commits(d.spark, f"{root}/commits")
    t = VersionedTable(
        d.spark, f"{root}/fact", schemas.FACT, months("sales_date"), commits=record, name="fact", keys=["sales_key"],
        derived={"sales_key": star.sales_key()},
    )
    t.publish(rows, gathered)
    return t


#: What a sale and an agreement meet by.
_RATED_BY = ["organizer_id", "reseller_id"]


def _by_key(d, df, keys, parts, name):
    """Rows landed in parts by hash of a key."""
    found = Parted(d.spark, scratch_dir(d.spark, name), df.schema)
    land(df, found.folder, "updated_at", part_of(keys, parts))
    return found


def _event_parts(d):
    return parts_of(staged(d)["events"].select("event_id", "organizer_id"), ["event_id"])


def _rate_parts(d):
    return parts_of(star.current_agreements(staged(d)["commission_agreements"]), _RATED_BY)


def _stored_sales(d, cut, parts):
    """The unified sales that the fact takes, written once, in parts by what they are rated
    by: what follows reads the given tables no more. Events of several parts (``cut``) are
    met part by part."""
    s = staged(d)
    if cut == 1:
        return _by_key(d, unified_sales(s, columns=star.FACT_INPUT), _RATED_BY, parts, "unified")
    schema = unified_sales({n: t.limit(0) for n, t in s.items()}, columns=star.FACT_INPUT).schema
    vendor = vendor_sales(s["reseller_daily_sales"], s["events"], s["resellers"])
    sold = _by_key(d, conform(vendor, schema), _RATED_BY, parts, "unified")
    tickets = _by_key(d, s["ticket_sales"].drop("organizer_id"), ["event_id"], cut, "tickets")
    for i in range(cut):
        events = s["events"].where(part_of(["event_id"], cut) == i)
        platform = platform_sales(tickets.only(i), events, s["customers"], s["resellers"], columns=star.FACT_INPUT)
        land(conform(platform, schema), sold.folder, "updated_at", part_of(_RATED_BY, parts), "append")
    return sold


def _agreements(d, parts):
    return _by_key(d, staged(d)["commission_agreements"], _RATED_BY, parts, "agreements")


def _rated(d, sold, agreed, parts):
    """Fact rows of sales and agreements that meet part by part, landed by month; without
    the key, which follows from two columns: read back it is worked out again."""
    columns = T.StructType([f for f in schemas.FACT if f.name != "sales_key"])
    found = Parted(d.spark, scratch_dir(d.spark, "rated"), columns)
    for i in range(parts):
        rows = star.fact_ticket_sales(sold(i), agreed(i)).drop("sales_key")
        land(rows, found.folder, "updated_at", F.date_format("sales_date", "yyyy-MM"), "append" if i else "overwrite")
    return found


def _single_fact(d):
    """Fact rows whose key no overlap and no repeated name multiplies, written once: a
    keyed merge takes one row a key. And whether each task's rows are of one month."""
    cut, parts = _event_parts(d), _rate_parts(d)
    gathered = cut > 1 or parts > 1
    if gathered:
        rated = _rated(d, _stored_sales(d, cut, parts).only, _agreements(d, parts).only, parts)
        rows, hashed = rated.gathered(), rated.read()
    else:
        # The key follows from two columns: read back it is worked out again, not stored.
        rows = hashed = _landed(d, fact(d).drop("sales_key"), "fact-rows")
    rows, hashed = (df.withColumn("sales_key", star.sales_key()) for df in (rows, hashed))
    # Hashes first: only rows that share one are grouped by the whole key.
    hashed = hashed.select("sales_key", "updated_at", F.xxhash64("sales_key").alias("k"))
    again = duplicate_keys(hashed, ["k"]).select("k").withColumn("updated_at", ts(RUN))
    few = _landed(d, again, "repeated-hashes").select("k")
    some = lookup_join(hashed, few, {"k": "k"}, "left_semi", measure=True)
    twice = duplicate_keys(some, ["sales_key"]).select("sales_key").withColumn("updated_at", ts(RUN))
    gone = _landed(d, twice, "repeated-keys").select("sales_key")
    return lookup_join(rows, gone, {"sales_key": "sales_key"}, "left_anti", measure=True), gathered


def _merge(d, table, rows, gathered=False):
    """Rows landed and merged by key; those whose tasks hold a month each stay so."""
    folder = scratch_dir(d.spark, "landing")
    if gathered:
        found = Parted(d.spark, folder, schemas.FACT)
        if land(conform(rows, schemas.FACT), folder, "updated_at", F.date_format("sales_date", "yyyy-MM"))["rows"]:
            table.upsert(found.read(), ["sales_key"], gathered=found.gathered())
    elif land(rows, folder)["rows"]:
        table.upsert(load_by_name(d.spark, folder, schemas.FACT), ["sales_key"])


@query("i05_both_feeds_stored_target")
def _(d):
    """Marks by feed over a stored fact: what came later, or earlier than the other feed's
    mark, is merged by key into the months it falls in."""
    files = F.col("source_system") == SYSTEM_FILES
    # File rows carry their load time; here a second load brings the later days.
    late = F.when(files, F.dayofmonth("sales_date") > 15).otherwise(F.col("updated_at") > ts(_CUT))
    loaded = F.when(files & ~late, ts("2024-01-20 00:00:00")).otherwise(F.col("updated_at"))
    rows, gathered = _single_fact(d)
    rows = rows.withColumn("updated_at", loaded)
    t = _stored_fact(d, rows.where(~late), gathered=gathered)
    _merge(d, t, incremental_rows(rows, t.read(), by="source_system"), gathered)
    return t.read().drop("updated_at")


def _old(agreements):
    return agreements.where(F.col("updated_at") < ts("1994-07-01 00:00:00"))


def _rerated(d, sold, agreed, parts):
    """Fact rows of the sales whose rate may have changed, landed by month."""
    found = Parted(d.spark, scratch_dir(d.spark, "landing"), schemas.FACT)

    def add(sales, periods, rates, **more):
        rows = star.fact_ticket_sales(star.rerated_sales(sales, sales.limit(0), periods, **more), rates)
        land(rows, found.folder, "updated_at", F.date_format("sales_date", "yyyy-MM"), "append")

    if parts == 1:
        add(sold.read(), star.changed_periods(_old(agreed.only(0)), agreed.only(0)), agreed.only(0))
        return found
    # Sales of several rows, which may be in several parts, are taken as wholes. Hashes tell
    # them: rows that share none are looked at one by one.
    keys = ["sales_id", "sales_source"]
    hashed = lambda df: df.withColumn("k", F.when(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull(), F.xxhash64(*keys)))
    again = duplicate_keys(hashed(sold.read()), ["k"], skip_nulls=True).select("k").withColumn("updated_at", ts(RUN))
    shared = _landed(d, again, "repeated-hashes").select("k")
    apart = lambda df, how: lookup_join(hashed(df), shared, {"k": "k"}, how, measure=True).drop("k")
    for i in range(parts):
        periods = star.changed_periods(_old(agreed.only(i)), agreed.only(i))
        add(apart(sold.only(i), "left_anti"), periods, agreed.only(i), single=True)
    whole = _landed(d, apart(sold.read(), "left_semi"), "whole-sales")
    everything = agreed.read()
    add(whole, star.changed_periods(_old(everything), everything), everything)
    return found


@query("i05_rerated_fact")
def _(d):
    """Agreements change after the fact was built: equal to a fact built with the new ones."""
    parts = _rate_parts(d)
    sold, agreed = _stored_sales(d, _event_parts(d), parts), _agreements(d, parts)
    if parts == 1:
        t = _stored_fact(d, star.fact_ticket_sales(sold.read(), _old(agreed.only(0))))
    else:
        rated = _rated(d, sold.only, lambda i: _old(agreed.only(i)), parts).gathered()
        t = _stored_fact(d, rated.withColumn("sales_key", star.sales_key()), gathered=True)
    rerated = _rerated(d, sold, agreed, parts)
    t.draft_replace(rerated.read(), ["sales_key"], rerated.gathered()).commit()
    return t.read()


@query("i05_shared_mark_loses_late_rows")
def _(d):
    f = _landed(d, fact(d), "fact-rows")
    files, early = F.col("source_system") == SYSTEM_FILES, F.col("updated_at") <= ts(_CUT)
    target = f.where(files | early)
    delta = incremental_rows(f, target)
    return upsert_by_hash(target, delta, ["sales_key"])


@query("i05_mark_per_feed")
def _(d):
    f = _landed(d, fact(d), "fact-rows")
    files, early = F.col("source_system") == SYSTEM_FILES, F.col("updated_at") <= ts(_CUT)
    target = f.where(files | early)
    delta = incremental_rows(f, target, by="source_system")
    return upsert_by_hash(target, delta, ["sales_key"])


@query("i05_schema_sync")
def _(d):
    old = _stored_orders(d).withColumn("gone", F.lit(1))
    new = _new_orders(d).withColumn("priority", F.lit("NEW"))
    return apply_upsert(*reconcile(old, new), ["o_orderkey"])


@query("i06_merge_by_name")
def _(d):
    keys, guard = schemas.VARIANT_KEYS["commission_agreements"]
    agreed = staging.stg_commissions(d.commission_agreements())
    fields = ["agreement_id", "organizer_id", "reseller_id", "commission_rate", "updated_at"]
    newest = [F.col("agreement_id").desc()]
    early = agreed.where(F.col("updated_at") < ts("1994-07-01 00:00:00"))
    target = latest_by(early, keys, newest).select(*fields)
    source = latest_by(agreed, keys, newest).select(*reversed(fields))
    return apply_upsert(*reconcile(target, source), keys, guard)


def _feed(d, root):
    ledgers = Ledgers(d.spark, f"{root}/audit")
    table = VersionedTable(d.spark, f"{root}/daily", schemas.DAILY_SALES)
    return DropFeed(d.spark, table, ledgers)


@query("i06_merges_by_name")
def _(d):
    """All seven guarded merges: what each table holds after a second load of changed rows."""
    raw = d.raw()
    found = []
    for name, (keys, guard) in schemas.VARIANT_KEYS.items():
        rows = raw[name]
        newest = [F.col(guard).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in rows.columns if c not in keys]]
        target = latest_by(rows.dropna(subset=list(keys)), keys, newest)
        # Of every third key the same row comes again, of the next a newer one.
        turn = F.ascii(F.substring(F.col(keys[-1]), -1, 1)) % 3
        source = target.select(*reversed(target.columns)).where(turn < 2)
        moved = F.when(turn == 1, F.expr(f"{guard} + interval 1 day")).otherwise(F.col(guard))
        source = source.withColumns({guard: moved, "batch_id": F.lit("BATCH_9")})
        merged = apply_upsert(*reconcile(target, source), keys, guard)
        found.append(merged.agg(
            F.count("*").alias("keys"), F.count_if(F.col("batch_id") == "BATCH_9").alias("updated"),
        ).select(F.lit(name).alias("table_name"), "keys", "updated"))
    return union(*found)


@query("i08_unseen_files")
def _(d):
    names = d.reseller_daily_sales().select(
        F.col("source_file_name").alias("file_name"),
        F.md5("source_file_name").alias("file_sha"), "created_date",
    ).distinct()
    first_half = F.col("created_date") < "2024-01-16"
    history = names.where(first_half).withColumn(
        "status", F.when(F.col("created_date") < "2024-01-10", "SUCCESS").otherwise("FAILED")
    )
    return unseen_files(names, history).select("file_name")


@query("i09_file_history")
def _(d):
    feed = _feed(d, scratch_dir(d.spark, "feed"))
    feed.load(export_drops(d.spark, d.folder), "BATCH_3", ts(RUN))
    return feed.ledgers.files.read().drop("file_sha")


@query("i09_failed_files")
def _(d):
    """Files of a foreign name fail, each with its row, and the others are loaded."""
    feed = _feed(d, scratch_dir(d.spark, "feed"))
    feed.load(export_drops(d.spark, d.folder, foreign=5), "BATCH_3", ts(RUN))
    return feed.ledgers.files.read().drop("file_sha")


@query("i10_load_files")
def _(d):
    feed = _feed(d, scratch_dir(d.spark, "feed"))
    folder = export_drops(d.spark, d.folder)
    feed.load(folder, "BATCH_3", ts(RUN))
    feed.load(folder, "BATCH_4", ts(RUN))  # nothing new: every file is known
    return feed.table.read()


@query("i11_job_audit")
def _(d):
    w = Warehouse(d.spark, scratch_dir(d.spark, "warehouse"))
    w.load_files(export_drops(d.spark, d.folder), "BATCH_3", ts(RUN))
    return w.ledgers.jobs.read().drop("end_time")


def _sources(d):
    raw = d.raw()
    return {
        name: conform(_typed(raw[name]), schema) for name, schema in schemas.SOURCES.items()
    }


def _typed(df):
    """Text fields of the derived raw tables as a database would hold them."""
    out = df
    for c in ("event_date", "purchase_date", "effective_from", "effective_to"):
        if c in df.columns:
            out = out.withColumn(c, fn.try_date(c))
    if "commission_rate" in df.columns:
        out = out.withColumn("commission_rate", fn.try_number("commission_rate", 5, 2))
    return out


@query("i12_full_reload")
def _(d):
    w = Warehouse(d.spark, scratch_dir(d.spark, "warehouse"))
    sources, folder = _sources(d), export_drops(d.spark, d.folder)
    days = iter(range(1, 9))

    def load(batch):
        at = ts(f"2024-03-0{next(days)} 00:00:00")
        counts = w.load_tables(sources, batch, at)
        return {**counts, "reseller_daily_sales": w.load_files(folder, batch, at)["rows"]}

    first, again = load("B1"), load("B2")
    w.full_reload("B3", ts(f"2024-03-0{next(days)} 00:00:00"))
    emptied = {n: t.row_count() for n, t in w.raw.items()}
    reloaded = load("B4")
    rows = [
        (n, first[n], again[n], emptied[n], reloaded[n], w.raw[n].read().count()) for n in w.raw
    ]
    return d.spark.createDataFrame(
        rows,
        "table_name string, loaded long, loaded_again long, after_reset long, reloaded long, stored long",
    )


@query("i13_load_then_marks")
def _(d):
    w = Warehouse(d.spark, scratch_dir(d.spark, "warehouse"))
    w.load_tables(_sources(d), "B1", ts(RUN))
    marks = current_watermarks(w.ledgers.watermarks.read()).select("source_table", "last_updated_at")
    counts = reports.row_counts({n: w.raw[n].read() for n in schemas.SOURCES})
    return marks.join(counts, F.col("source_table") == F.col("table_name")).drop("table_name")


@query("i10_stream_files")
def _(d):
    folder = export_drops(d.spark, d.folder)
    root = scratch_dir(d.spark, "stream")
    stream_drops(d.spark, folder, f"{root}/out", f"{root}/state", ts(RUN)).awaitTermination()
    stored = d.spark.read.schema(schemas.DAILY_SALES).parquet(f"{root}/out/rows/epoch=*")
    return stored.drop("batch_id")


# -- data quality ----------------------------------------------------------


def _suite(d, kind):
    checks = [c for c in quality.model_checks() if c.name.startswith(kind)]
    return run_checks(models(d, checks), checks)


@query("i13_one_commit")
def _(d):
    """Rows that readers see when a load dies between two tables, and after it was repeated."""
    root = scratch_dir(d.spark, "loaded")
    s = staged(d)
    names = ("organizers", "resellers", "events")
    tables = lambda: {
        n: VersionedTable(d.spark, f"{root}/{n}", s[n].schema, commits=c, name=n)
        for c in [Commits(d.spark, f"{root}/commits")] for n in names
    }
    key = {n: schemas.SOURCE_KEYS[n][0] for n in names}
    early = {n: s[n].where(F.ascii(F.substring(key[n][0], -1, 1)) % 2 == 0) for n in names}
    commit_together([t.draft(early[n]) for n, t in tables().items()], "first")
    seen = []
    counts = lambda step: union(*(t.read().agg(F.count("*").alias("rows")).select(F.lit(step).alias("step"), F.lit(n).alias("table_name"), "rows") for n, t in tables().items()))
    drafts = [t.draft_upsert(s[n], key[n]) for n, t in tables().items()]
    for draft in drafts[:2]:
        draft.prepare()
    seen.append(counts("died"))
    commit_together([t.draft_upsert(s[n], key[n]) for n, t in tables().items()], "again")
    seen.append(counts("repeated"))
    return union(*seen)


@query("q01_unique")
def _(d):
    return _suite(d, "unique")


@query("q01_q04_standing_checks")
def _(d):
    """Uniqueness and orphans after sales were changed and resellers went, from the changes alone."""
    s, root = staged(d), scratch_dir(d.spark, "standing")
    sold = s["ticket_sales"].select("ticket_id", "reseller_id", "event_id", "purchase_date", "updated_at")
    checks = [unique("sales", "event_id"), related("sales", "reseller_id", "resellers", "reseller_id"), related("sales", "event_id", "events", "event_id", True)]
    record = Commits(d.spark, f"{root}/record")
    parents = {n: s[n].select(k) for n, k in (("resellers", "reseller_id"), ("events", "event_id"))}
    tables = {
        "sales": VersionedTable(d.spark, f"{root}/sales", sold.schema, months("purchase_date"), commits=record, name="sales", keys=["ticket_id"]),
        **{n: VersionedTable(d.spark, f"{root}/{n}", df.schema, commits=record, name=n) for n, df in parents.items()},
    }
    early = F.col("purchase_date") < F.lit("1998-01-01").cast("date")
    commit_together([tables["sales"].draft(sold.where(early)), *(tables[n].draft(df) for n, df in parents.items())])
    standing = StandingChecks(d.spark, f"{root}/checks", checks, 16)
    standing.refresh(tables)
    folder = scratch_dir(d.spark, "landing")
    land(sold.where(~early | early.isNull()), folder)
    even = F.ascii(F.substring("reseller_id", -1, 1)) % 2 == 0
    commit_together([
        tables["sales"].draft_upsert(load_by_name(d.spark, folder, sold.schema), ["ticket_id"]),
        tables["resellers"].draft(parents["resellers"].where(even)),
    ])
    return standing.refresh(tables)


@query("q02_not_null")
def _(d):
    return _suite(d, "not_null")


@query("q03_accepted_values")
def _(d):
    return _suite(d, "accepted_values")


@query("q04_relationships")
def _(d):
    return _suite(d, "relationships")


@query("q05_duplicate_sales")
def _(d):
    return duplicate_keys(sales(d), ["sales_id"], skip_nulls=True)


@query("q06_negative_amount")
def _(d):
    return sales(d).where("total_amount < 0").select(
        "sales_id", "ticket_id", "transaction_id", "total_amount", "source_system"
    )


@query("q07_quantity_not_positive")
def _(d):
    return sales(d).where("quantity <= 0").select(
        "sales_id", "ticket_id", "transaction_id", "quantity", "source_system"
    )


@query("q08_future_sales")
def _(d):
    as_of = F.lit("2001-01-01").cast("date")
    return sales(d).where(fn.future("sales_date", as_of)).select("sales_id", "sales_date")


@query("q09_commission_rate_range")
def _(d):
    c = staging.stg_commissions(d.commission_agreements())
    outside = "commission_rate < 0 OR commission_rate > 100"
    return run_checks(
        {"stg_commissions": c},
        [
            bad_rows("null_is_bad", "stg_commissions", f"{outside} OR commission_rate IS NULL"),
            bad_rows("null_passes", "stg_commissions", outside),
        ],
    )


@query("q10_amount_mismatch")
def _(d):
    t = staging.stg_ticket_sales(d.ticket_sales())
    return t.where("round(quantity * unit_price, 2) <> total_amount").select(
        "ticket_id", "quantity", "unit_price", "total_amount"
    )


@query("q11_price_and_date_bounds")
def _(d):
    s = staged(d)
    checks = [
        c for c in quality.source_checks("1995-06-01", "2001-06-30")
        if c.name in ("unit_price_positive", "event_date_range", "purchase_date_range")
    ]
    return run_checks(s, checks)


@query("q12_null_critical_fields")
def _(d):
    t = "ticket_sales"
    return run_checks(
        staged(d), [not_null(t, c) for c in ("event_id", "customer_id", "reseller_id")]
    )


@query("q13_source_report")
def _(d):
    return run_checks(staged(d), quality.source_checks("1995-01-01", "2001-08-01"))


@query("q14_rejects")
def _(d):
    _, bad = positional_drops(
        d.spark, export_positional(d.spark, d.folder), "BATCH_3", ts(RUN)
    )
    event = F.get_json_object("raw_payload", "$.event_id").cast("bigint")
    seller = F.get_json_object("raw_payload", "$.reseller_name")
    return bad.select(
        "batch_id", "source_name", "reason", "rejected_at",
        event.alias("event_id"), seller.alias("reseller_name"),
    )


@query("q15_check_log")
def _(d):
    ledgers = Ledgers(d.spark, scratch_dir(d.spark, "audit"))
    log = run_checks(
        staged(d),
        [accepted("ticket_sales", "sales_channel", CHANNELS), not_null("events", "event_date")],
    )
    ledgers.checks.append(
        log.withColumns({"batch_id": F.lit("B1"), "checked_at": ts(RUN)})
    )
    return ledgers.checks.read()


@query("q16_write_audit_publish")
def _(d):
    """What readers see after a refused version and after a mended one."""
    root = scratch_dir(d.spark, "audited")
    rows = _landed(d, staging.stg_ticket_sales(d.ticket_sales()).select("ticket_id", "sales_channel", "purchase_date", "updated_at"), "tickets")
    good = F.col("sales_channel").isin(CHANNELS)
    open_ = lambda: VersionedTable(
        d.spark, f"{root}/t", rows.schema, months("purchase_date"), commits=Commits(d.spark, f"{root}/commits"), name="t", keys=["ticket_id"]
    )
    open_().publish(rows.where(good))
    check = [accepted("t", "sales_channel", CHANNELS)]
    seen = []
    for step, delta in (("refused", rows.where(~good)), ("mended", rows.where(~good).withColumn("sales_channel", F.lit(CHANNELS[0])))):
        draft = open_().draft_upsert(delta, ["ticket_id"])
        try:
            assert_checks(run_checks({"t": draft.read()}, check))
            draft.commit(step)
        except ChecksFailed:
            pass
        seen.append(totals(open_().read(), [F.lit(step).alias("step"), "sales_channel"], {"sales": F.count("*")}))
    return union(*seen)


@query("q16_gate")
def _(d):
    log = run_checks(
        staged(d),
        [
            not_null("ticket_sales", "ticket_id"),
            accepted("ticket_sales", "sales_channel", CHANNELS),
        ],
    )
    try:
        assert_checks(log)
        outcome = "build"
    except ChecksFailed:
        outcome = "stop"
    warned = len(assert_checks(log, severity="warn"))
    return log.agg(F.sum("failed_count").alias("failed_rows")).select(
        F.lit(outcome).alias("outcome"), F.lit(warned).alias("failed_checks"), "failed_rows"
    )


# -- models and reports ----------------------------------------------------


@query("m01_int_sales_transactions")
def _(d):
    return sales(d)


@query("m02_fact_ticket_sales")
def _(d):
    return fact(d)


@query("m03_dim_customer")
def _(d):
    return dims(d)["dim_customer"]


@query("m03_dim_reseller")
def _(d):
    return dims(d)["dim_reseller"]


@query("m03_dim_organizer")
def _(d):
    return dims(d)["dim_organizer"]


@query("m04_dim_event")
def _(d):
    return dims(d)["dim_event"]


@query("m05_dim_date")
def _(d):
    return star.dim_date(sales(d))


@query("r01_weekly_by_channel")
def _(d):
    return reports.weekly_by_channel(fact(d))


def _summed(d):
    """Daily sums of a stored fact, brought up to date after late rows and new amounts
    were merged into it."""
    whole, gathered = _single_fact(d)
    turn = F.pmod(F.xxhash64("sales_key"), F.lit(50))
    zero = F.when(turn == 1, F.lit(0)).otherwise(F.col("total_amount")).cast("decimal(18,2)")
    t = _stored_fact(d, whole.where(turn > 0).withColumn("total_amount", zero), gathered=gathered)
    sums = DailySums(t, scratch_dir(d.spark, "sums"), months)
    sums.refresh()
    _merge(d, t, whole.where(turn < 2), gathered)
    sums.refresh()
    return sums


@query("r01_weekly_kept_up_to_date")
def _(d):
    return _summed(d).weekly_by_channel()


@query("r02_february_comparison")
def _(d):
    return reports.month_comparison(fact(d), 2, 2000, 1999)


@query("r03_by_reseller_and_event_type")
def _(d):
    x = dims(d)
    return reports.sales_for(fact(d), x["dim_event"], x["dim_reseller"])


@query("r03_chosen_resellers_and_types")
def _(d):
    events, chosen = dims(d)["dim_event"], [f"RES{k:09d}" for k in range(1, 5)]
    types = [r[0] for r in events.select("event_type").distinct().orderBy("event_type").limit(3).collect()]
    return reports.sales_for(fact(d), events, dims(d)["dim_reseller"], chosen, types)


@query("r04_commission_bands")
def _(d):
    return reports.commission_bands(fact(d))


@query("r04_commission_by_reseller")
def _(d):
    return reports.commission_by_reseller(fact(d))


@query("r05_popular_by_region")
def _(d):
    return reports.popular_events(fact(d), dims(d)["dim_event"], 5)


@query("r06_revenue_by_year")
def _(d):
    return reports.revenue_by_year(fact(d), "sales_date")


@query("r07_top_events")
def _(d):
    t = staging.stg_ticket_sales(d.ticket_sales())
    events = staging.stg_events(d.events())
    return reports.top_by_revenue(t, events, "event_id", "event_name")


@query("r07_top_resellers")
def _(d):
    t = staging.stg_ticket_sales(d.ticket_sales())
    resellers = staging.stg_resellers(d.resellers())
    return reports.top_by_revenue(t, resellers, "reseller_id", "reseller_name")


@query("r08_by_seller_type")
def _(d):
    return reports.report(fact(d), ["seller_type", "sales_channel"])


@query("r08_top_customers")
def _(d):
    customers = dims(d)["dim_customer"].select("customer_id", "email")
    return reports.report(
        fact(d), ["customer_id", "email"], {"customer_id": customers}, top=20
    )


@query("r08_by_reseller_location")
def _(d):
    located = dims(d)["dim_reseller"].select("reseller_id", "region", "country")
    return reports.report(fact(d), ["region", "country"], {"reseller_id": located})


@query("r08_by_event_type")
def _(d):
    typed = dims(d)["dim_event"].select("event_id", "event_type", "region")
    return reports.report(
        fact(d), ["event_type"], {"event_id": typed}, where="region <> 'ASIA'"
    )


@query("r09_measures_by_year")
def _(d):
    f = fact(d)
    dates = star.dim_date(f).select(F.col("date_key").alias("sales_date"), "year")
    return reports.report(f, ["year"], {"sales_date": dates})


@query("r10_row_counts")
def _(d):
    return reports.row_counts(d.raw())
