"""Explicit schemas of source tables, drop files, ledgers and models."""

from pyspark.sql import types as T

_META = "batch_id string, load_ts timestamp_ntz, source_system string"


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _type(name: str) -> T.DataType:
    if name.startswith("decimal"):
        precision, scale = name[8:-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _TYPES[name]


def fields(listed: str) -> T.StructType:
    """Schema from ``name type, name type``; needs no running session."""
    pairs = [f.split() for f in listed.split(", ")]
    return T.StructType([T.StructField(n, _type(t)) for n, t in pairs])


ORGANIZERS = fields(
    "organizer_id string, organizer_name string, country string, region string, "
    "updated_at timestamp_ntz"
)
RESELLERS = fields(
    "reseller_id string, reseller_name string, country string, region string, "
    "updated_at timestamp_ntz"
)
AGREEMENTS = fields(
    "agreement_id int, organizer_id string, reseller_id string, "
    "commission_rate decimal(5,2), effective_from date, effective_to date, "
    "updated_at timestamp_ntz"
)
EVENTS = fields(
    "event_id string, organizer_id string, event_name string, event_type string, "
    "venue string, region string, event_date date, updated_at timestamp_ntz"
)
CUSTOMERS = fields(
    "customer_id string, first_name string, last_name string, email string, "
    "country string, updated_at timestamp_ntz"
)
TICKET_SALES = fields(
    "ticket_id string, event_id string, organizer_id string, reseller_id string, "
    "seller_type string, seller_id string, seller_name string, customer_id string, "
    "sales_channel string, quantity int, unit_price decimal(10,2), "
    "total_amount decimal(12,2), purchase_date date, updated_at timestamp_ntz"
)
SOURCES = {
    "organizers": ORGANIZERS,
    "resellers": RESELLERS,
    "commission_agreements": AGREEMENTS,
    "events": EVENTS,
    "customers": CUSTOMERS,
    "ticket_sales": TICKET_SALES,
}
# The master CSVs carry the source columns without the change stamp.
MASTER_CSV = {
    name: T.StructType([f for f in schema if f.name != "updated_at"])
    for name, schema in SOURCES.items()
}
# Key of each source table and whether its upsert keeps the newer row.
SOURCE_KEYS = {
    "organizers": (["organizer_id"], None),
    "resellers": (["reseller_id"], None),
    "commission_agreements": (["agreement_id"], None),
    "events": (["event_id"], None),
    "customers": (["customer_id"], None),
    "ticket_sales": (["ticket_id"], "updated_at"),
}
# The by-name merge variant: every table guarded, other keys for two of them. Daily
# sales have no sale date but the day that the row was made.
VARIANT_KEYS = {
    **{name: (keys, "updated_at") for name, (keys, _) in SOURCE_KEYS.items()},
    "commission_agreements": (["organizer_id", "reseller_id"], "updated_at"),
    "reseller_daily_sales": (["reseller_id", "created_date"], "updated_at"),
}
RAW = {
    name: T.StructType(list(schema) + list(fields(_META)))
    for name, schema in SOURCES.items()
}
DAILY_SALES = fields(
    "transaction_id decimal(38,0), reseller_id string, event_name string, "
    "number_of_purchased_tickets decimal(10,0), total_amount decimal(12,2), "
    "sales_channel string, customer_first_name string, customer_last_name string, "
    "office_location string, created_date date, source_file_name string, "
    "batch_id string, updated_at timestamp_ntz, load_ts timestamp_ntz, "
    "source_system string"
)
RAW["reseller_daily_sales"] = DAILY_SALES

# The alternate, positional layout of a reseller export.
POSITIONAL_DROP = fields(
    "sale_date date, reseller_id string, reseller_name string, "
    "reseller_region string, event_id bigint, event_name string, "
    "event_type string, ticket_type_id bigint, ticket_name string, "
    "sales_channel string, quantity int, unit_price decimal(12,2), "
    "gross_amount decimal(12,2), commission_rate decimal(5,2), "
    "customer_email string, currency string"
)

WATERMARKS = fields(
    "source_table string, last_updated_at timestamp_ntz, "
    "updated_ts timestamp_ntz, batch_id string"
)
FILE_HISTORY = fields(
    "file_name string, file_sha string, load_date timestamp_ntz, "
    "record_count bigint, status string, error_message string"
)
# Hash and header by what tells a file without opening it.
SEEN_FILES = fields(
    "file_path string, file_size bigint, modified timestamp_ntz, file_sha string, "
    "header string"
)
JOB_AUDIT = fields(
    "job_name string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "status string, records_loaded bigint, files_processed bigint, "
    "error_message string"
)
REJECTS = fields(
    "batch_id string, source_name string, source_file string, reason string, "
    "raw_payload string, rejected_at timestamp_ntz"
)
CHECK_LOG = fields(
    "batch_id string, check_name string, table_name string, status string, "
    "failed_count bigint, checked_at timestamp_ntz"
)

SALES_COLUMNS = [
    "sales_id", "sales_source", "transaction_id", "ticket_id", "event_id",
    "event_name", "organizer_id", "customer_id", "customer_first_name",
    "customer_last_name", "reseller_id", "reseller_name", "sales_channel",
    "seller_id", "seller_type", "seller_name", "quantity", "total_amount",
    "unit_price", "sales_date", "office_location", "source_file_name",
    "load_ts", "source_system", "batch_id", "updated_at",
]
FACT = fields(
    "sales_key string, sales_id string, sales_source string, customer_id string, "
    "reseller_id string, organizer_id string, event_id string, sales_date date, "
    "sales_channel string, seller_type string, seller_id string, "
    "seller_name string, quantity decimal(38,0), unit_price decimal(38,8), "
    "total_amount decimal(18,2), commission_rate decimal(5,2), "
    "commission_amount decimal(18,2), source_file_name string, "
    "source_system string, batch_id string, load_ts timestamp_ntz, "
    "updated_at timestamp_ntz"
)
