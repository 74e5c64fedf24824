"""Unified sales: both feeds in one shape."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import SELLER_RESELLER, SOURCE_PLATFORM, SOURCE_VENDOR
from ..functions import join_name, unit_price
from ..functions.numbers import UNIT_PRICE
from ..operators.joins import hot_for, lookup_join, name_join
from ..schemas import SALES_COLUMNS

def _no_text() -> Column:
    return F.lit(None).cast("string")


def vendor_sales(
    daily: DataFrame, events: DataFrame, resellers: DataFrame, hot: Mapping = {}
) -> DataFrame:
    """Sales from reseller files; the event is found by its normalised name."""
    spread = ["transaction_id"]
    event_ref = events.select(
        F.col("event_name").alias("_event_name"), "event_id", "organizer_id"
    )
    named = name_join(
        daily, event_ref, "event_name", "_event_name", spread, hot.get("event_name", ()), measure=True
    )
    reseller_ref = resellers.select("reseller_id", "reseller_name")
    full = lookup_join(
        named,
        reseller_ref,
        {"reseller_id": "reseller_id"},
        "left",
        spread=spread,
        hot=hot.get("daily_reseller", ()),
        measure=True,
    )
    return full.select(
        F.col("transaction_id").alias("sales_id"),
        F.lit(SOURCE_VENDOR).alias("sales_source"),
        "transaction_id",
        _no_text().alias("ticket_id"),
        "event_id",
        "event_name",
        "organizer_id",
        _no_text().alias("customer_id"),
        "customer_first_name",
        "customer_last_name",
        "reseller_id",
        "reseller_name",
        "sales_channel",
        F.col("reseller_id").alias("seller_id"),
        F.lit(SELLER_RESELLER).alias("seller_type"),
        F.col("reseller_name").alias("seller_name"),
        F.col("number_of_purchased_tickets").cast("decimal(38,0)").alias("quantity"),
        "total_amount",
        unit_price("total_amount", "number_of_purchased_tickets").alias("unit_price"),
        F.col("created_date").alias("sales_date"),
        "office_location",
        "source_file_name",
        "load_ts",
        "source_system",
        "batch_id",
        "updated_at",
    )


def platform_sales(
    tickets: DataFrame,
    events: DataFrame,
    customers: DataFrame,
    resellers: DataFrame,
    hot: Mapping = {},
    columns: Sequence[str] = SALES_COLUMNS,
) -> DataFrame:
    """Sales of the platform; the organizer comes from the event.

    columns  the sales columns that are wanted: a reference table none of whose
             columns is among them only multiplies the sales of its repeated keys
    """
    spread = ["ticket_id"]
    names = {"first_name": "customer_first_name", "last_name": "customer_last_name"}
    sales = lookup_join(
        tickets.drop("organizer_id"),
        events.select("event_id", *[c for c in ("event_name", "organizer_id") if c in columns]),
        {"event_id": "event_id"},
        spread=spread,
        hot=hot.get("event", ()),
        measure=True,
    )
    sales = lookup_join(
        sales,
        customers.select("customer_id", *[F.col(c).alias(n) for c, n in names.items() if n in columns]),
        {"customer_id": "customer_id"},
        spread=spread,
        hot=hot.get("customer", ()),
        measure=True,
    )
    sales = lookup_join(
        sales,
        resellers.select("reseller_id", *[c for c in ("reseller_name",) if c in columns]),
        {"reseller_id": "reseller_id"},
        spread=spread,
        hot=hot.get("reseller", ()),
        measure=True,
    )
    wanted = [
        F.col("ticket_id").alias("sales_id"),
        F.lit(SOURCE_PLATFORM).alias("sales_source"),
        _no_text().alias("transaction_id"),
        "ticket_id",
        "event_id",
        "event_name",
        "organizer_id",
        "customer_id",
        "customer_first_name",
        "customer_last_name",
        "reseller_id",
        "reseller_name",
        "sales_channel",
        "seller_id",
        "seller_type",
        "seller_name",
        F.col("quantity").cast("decimal(38,0)").alias("quantity"),
        "total_amount",
        F.col("unit_price").cast(UNIT_PRICE).alias("unit_price"),
        F.col("purchase_date").alias("sales_date"),
        _no_text().alias("office_location"),
        _no_text().alias("source_file_name"),
        "load_ts",
        "source_system",
        "batch_id",
        "updated_at",
    ]
    return sales.select(*[c for n, c in zip(SALES_COLUMNS, wanted, strict=True) if n in columns])


def hot_sales_keys(staged: Mapping[str, DataFrame]) -> dict[str, Sequence[int]]:
    """Hot keys of the sales feeds for each reference table too large to broadcast."""
    tickets, daily = staged["ticket_sales"], staged["reseller_daily_sales"]
    events, resellers = staged["events"], staged["resellers"]
    named = daily.select(join_name("event_name").alias("_name"))
    return {
        "event": hot_for(tickets, ["event_id"], events),
        "customer": hot_for(tickets, ["customer_id"], staged["customers"]),
        "reseller": hot_for(tickets, ["reseller_id"], resellers),
        "event_name": hot_for(named, ["_name"], events),
        "daily_reseller": hot_for(daily, ["reseller_id"], resellers),
    }


def unified_sales(
    staged: Mapping[str, DataFrame], hot: Mapping = {}, columns: Sequence[str] = SALES_COLUMNS
) -> DataFrame:
    """All sales in 26 columns, or in some of them. Duplicate names or ids on a
    reference side fan out.

    ``hot`` comes from ``hot_sales_keys``; without it only rows with null keys are
    spread, and hot keys are left to adaptive skew splitting.
    """
    events, resellers = staged["events"], staged["resellers"]
    vendor = vendor_sales(staged["reseller_daily_sales"], events, resellers, hot)
    platform = platform_sales(
        staged["ticket_sales"], events, staged["customers"], resellers, hot, columns
    )
    vendor = vendor.select(*[c for c in SALES_COLUMNS if c in columns])
    return vendor.unionByName(platform)
