"""Surrogate keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import KEY_JOINER, KEY_NULL
from .text import _col


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 over the joined text of the columns, nulls as a fixed token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL)) for c in columns]
    return F.md5(F.concat_ws(KEY_JOINER, *parts))
