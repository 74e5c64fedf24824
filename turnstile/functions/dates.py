"""Dates: lenient casts and calendar parts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"[T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?"


def try_date(c: Column | str, pattern: str | None = None) -> Column:
    """Date or null. The text must be a whole date, with or without a valid time;
    with a pattern it must match that in full."""
    if pattern is not None:
        return F.try_to_date(_col(c), pattern)
    text = F.trim(_col(c).cast("string"))
    # A plain cast takes a year, a month or any text after a date as well.
    return F.when(text.rlike(f"^{_DAY}$"), text.try_cast("date")).when(
        text.rlike(f"^{_DAY}{_TIME}$"), text.try_cast("timestamp_ntz").cast("date")
    )


def date_parts(c: Column | str) -> dict[str, Column]:
    """The parts a date dimension carries, by name, in order."""
    d = _col(c)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.monthname(d),
        "week_number": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
    }


def week_start(c: Column | str) -> Column:
    """Monday of the week; safe across year ends where a week number is not."""
    return F.trunc(_col(c), "week")


def future(c: Column | str, as_of: Column | None = None) -> Column:
    return _col(c) > (F.current_date() if as_of is None else as_of)
