"""Literals, names and patterns that results depend on."""

# Where a sale came from.
SOURCE_PLATFORM = "B2B PLATFORM"
SOURCE_VENDOR = "VENDOR PLATFORM"

# Who sold it.
SELLER_ORGANIZER = "ORGANIZER"
SELLER_RESELLER = "RESELLER"

# Feed that delivered the row.
SYSTEM_DATABASE = "NEON"
SYSTEM_FILES = "GITHUB"

CHANNELS = ["WEB", "MOBILE_APP", "ON_SITE"]

# Null token and joiner of the surrogate key.
KEY_NULL = "_dbt_utils_surrogate_key_null_"
KEY_JOINER = "-"

# Start of time for watermarks, end of time for open agreements.
EPOCH_MARK = "1900-01-01 00:00:00"
OPEN_END = "2999-12-31"

# Plausible range of event and purchase dates in source validation.
RANGE_START = "2019-01-01"
RANGE_END = "2020-12-31"

# Characters, besides the blank, after which initcap starts a new word.
WORD_BREAKS = r'[!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>\t\n\r]'

# Names of reseller files: the loader's rule and the strict rule.
FILE_NAME_LOOSE = r"(?i)^DailySales_(\d{8})_(RES\d+)\.csv"
FILE_NAME_STRICT = r"(?i)^DailySales_(\d{2}\d{2}\d{4})_([A-Za-z0-9_-]+)\.csv$"

# Header of a reseller file and the column it lands in.
DROP_HEADERS = {
    "Transaction ID": "transaction_id",
    "Event name": "event_name",
    "Number of purchased tickets": "number_of_purchased_tickets",
    "Total amount": "total_amount",
    "Sales channel": "sales_channel",
    "Customer first name": "customer_first_name",
    "Customer last name": "customer_last_name",
    "Office location": "office_location",
    "Created Date": "created_date",
}
