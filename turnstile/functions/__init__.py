from .dates import date_parts, future, try_date, week_start
from .filenames import drop_file_date, drop_file_reseller, table_from_file
from .keys import surrogate_key
from .numbers import commission, safe_divide, try_number, unit_price
from .text import blank_to_null, clean, initcap_wide, join_name, lower_clean, upper_clean

__all__ = [
    "blank_to_null", "clean", "commission", "date_parts", "drop_file_date",
    "drop_file_reseller", "future", "initcap_wide", "join_name", "lower_clean",
    "safe_divide", "surrogate_key", "table_from_file", "try_date", "try_number",
    "unit_price", "upper_clean", "week_start",
]
