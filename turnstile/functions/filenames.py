"""What a reseller file's name says."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import FILE_NAME_STRICT
from .dates import try_date
from .text import _col


def _group(name: Column | str, group: int, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(_col(name), pattern, group), F.lit(""))


def drop_file_date(name: Column | str, pattern: str = FILE_NAME_STRICT) -> Column:
    """Sale date in the name; null for a foreign name or an impossible date."""
    return try_date(_group(name, 1, pattern), "MMddyyyy")


def drop_file_reseller(name: Column | str, pattern: str = FILE_NAME_STRICT) -> Column:
    """Reseller in the name, in the case it is written; null for a foreign name."""
    return _group(name, 2, pattern)


def table_from_file(name: Column | str) -> Column:
    """Table a file would be loaded into: its name without ``.csv``, upper case."""
    return F.upper(F.replace(_col(name), F.lit(".csv"), F.lit("")))
