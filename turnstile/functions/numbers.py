"""Decimal arithmetic with explicit result types."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

MONEY = "decimal(18,2)"
UNIT_PRICE = "decimal(38,8)"


def try_number(c: Column | str, precision: int = 38, scale: int = 0) -> Column:
    """Number or null; rounds half up, null on bad text and on overflow."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def unit_price(total: Column | str, tickets: Column | str) -> Column:
    """Total per ticket at scale 8, null for zero tickets."""
    return (_col(total) / F.nullif(_col(tickets), F.lit(0))).cast(UNIT_PRICE)


def commission(total: Column | str, rate: Column | str) -> Column:
    """Percentage of the total, half-up to cents; nulls count as zero."""
    zero = F.lit(0)
    exact = F.coalesce(_col(total), zero) * F.coalesce(_col(rate), zero) / F.lit(100)
    return F.round(exact, 2).cast(MONEY)


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """Quotient, null where the divisor is zero or null."""
    return F.try_divide(_col(a), _col(b))
