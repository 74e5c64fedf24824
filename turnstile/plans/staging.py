"""Cleansed views of the raw tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    blank_to_null,
    clean,
    initcap_wide,
    lower_clean,
    try_date,
    try_number,
    upper_clean,
)
from ..operators.incremental import incremental_rows

_META = ["load_ts", "source_system", "batch_id", "updated_at"]


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean("customer_id").alias("customer_id"),
        initcap_wide(clean("first_name")).alias("first_name"),
        initcap_wide(clean("last_name")).alias("last_name"),
        lower_clean("email").alias("email"),
        *_META,
    )


def stg_events(raw: DataFrame) -> DataFrame:
    text = ["event_id", "organizer_id", "event_name", "event_type", "venue"]
    return raw.select(
        *[clean(c).alias(c) for c in text],
        upper_clean("region").alias("region"),
        try_date("event_date").alias("event_date"),
        *_META,
    )


def stg_organizers(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean("organizer_id").alias("organizer_id"),
        clean("organizer_name").alias("organizer_name"),
        upper_clean("region").alias("region"),
        *_META,
    )


def stg_resellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean("reseller_id").alias("reseller_id"),
        clean("reseller_name").alias("reseller_name"),
        upper_clean("country").alias("country"),
        upper_clean("region").alias("region"),
        *_META,
    )


def stg_commissions(raw: DataFrame) -> DataFrame:
    return raw.select(
        try_number("agreement_id").alias("agreement_id"),
        upper_clean("organizer_id").alias("organizer_id"),
        upper_clean("reseller_id").alias("reseller_id"),
        try_number("commission_rate", 5, 2).alias("commission_rate"),
        try_date("effective_from").alias("effective_from"),
        try_date("effective_to").alias("effective_to"),
        F.col("load_ts").cast("timestamp_ntz").alias("load_ts"),
        upper_clean("source_system").alias("source_system"),
        clean("batch_id").alias("batch_id"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


def stg_reseller_daily_sales(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean(F.col("transaction_id").cast("string")).alias("transaction_id"),
        upper_clean("reseller_id").alias("reseller_id"),
        clean("event_name").alias("event_name"),
        F.col("number_of_purchased_tickets")
        .cast("decimal(38,0)")
        .alias("number_of_purchased_tickets"),
        F.col("total_amount").cast("decimal(18,2)").alias("total_amount"),
        upper_clean("sales_channel").alias("sales_channel"),
        initcap_wide(clean("customer_first_name")).alias("customer_first_name"),
        initcap_wide(clean("customer_last_name")).alias("customer_last_name"),
        clean("office_location").alias("office_location"),
        try_date("created_date").alias("created_date"),
        "source_file_name",
        *_META,
    )


def stg_ticket_sales(
    raw: DataFrame, target: DataFrame | None = None, mark: Column | None = None
) -> DataFrame:
    """Cleansed ticket sales; with a target or a mark, only what changed since."""
    cleaned = raw.select(
        clean("ticket_id").alias("ticket_id"),
        clean("event_id").alias("event_id"),
        clean("organizer_id").alias("organizer_id"),
        blank_to_null("reseller_id").alias("reseller_id"),
        clean("seller_id").alias("seller_id"),
        upper_clean("seller_type").alias("seller_type"),
        upper_clean("seller_name").alias("seller_name"),
        clean("customer_id").alias("customer_id"),
        upper_clean("sales_channel").alias("sales_channel"),
        clean("batch_id").alias("batch_id"),
        F.col("quantity").cast("decimal(10,0)").alias("quantity"),
        F.col("unit_price").cast("decimal(18,2)").alias("unit_price"),
        F.col("total_amount").cast("decimal(18,2)").alias("total_amount"),
        try_date("purchase_date").alias("purchase_date"),
        "load_ts",
        clean("source_system").alias("source_system"),
        "updated_at",
    )
    if target is None and mark is None:
        return cleaned
    return incremental_rows(cleaned, target, mark=mark)


STAGING = {
    "customers": stg_customers,
    "events": stg_events,
    "organizers": stg_organizers,
    "resellers": stg_resellers,
    "commission_agreements": stg_commissions,
    "ticket_sales": stg_ticket_sales,
    "reseller_daily_sales": stg_reseller_daily_sales,
}


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stage(raw[name]) for name, stage in STAGING.items() if name in raw}
