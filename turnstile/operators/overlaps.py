"""Periods of one key that overlap, and what they would multiply.

A join to the period in force yields a row for each that holds. Periods that
overlap so multiply sales without any error; these operators show them first.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import OPEN_END
from .joins import lookup_join


def _until(end: str) -> Column:
    return F.coalesce(F.col(end), F.lit(OPEN_END).cast("date"))


def overlapping_periods(
    periods: DataFrame,
    keys: Sequence[str],
    start: str = "effective_from",
    end: str = "effective_to",
    island: str = "island",
) -> DataFrame:
    """Periods that share a day with another of their key, with the number of the
    stretch of touching periods they are in.

    One sort by key and start: a period opens a new stretch if it begins after the
    latest end so far. Both ends belong to a period, a null end is open. Periods
    with a null key or start, or that end before they begin, hold on no day.
    """
    until = _until(end)
    held = periods.dropna(subset=[*keys, start]).where(until >= F.col(start))
    order = Window.partitionBy(*keys).orderBy(start, until)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    latest = F.max(until).over(before)
    opens = F.coalesce(F.col(start) > latest, F.lit(True))
    numbered = held.withColumn("_opens", opens.cast("int")).withColumn(island, F.sum("_opens").over(so_far))
    size = F.count("*").over(Window.partitionBy(*keys, island))
    return numbered.withColumn("_size", size).where("_size > 1").drop("_opens", "_size")


def multiplied_rows(
    df: DataFrame,
    periods: DataFrame,
    keys: Sequence[str],
    at: str,
    row: Sequence[str],
    start: str = "effective_from",
    end: str = "effective_to",
    name: str = "periods",
    spread: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``df``, named by the columns ``row``, on whose day several periods of
    their key hold, with their number.

    Only the periods that overlap are joined, so where none do nothing is.
    """
    double = overlapping_periods(periods.select(*keys, start, end), keys, start, end).drop("island")
    within = (F.col(at) >= F.col(start)) & (F.col(at) <= _until(end))
    columns = list(dict.fromkeys([*row, *keys, at]))
    met = lookup_join(df.select(*columns), double, {k: k for k in keys}, "inner", within, spread)
    return met.groupBy(*row).agg(F.count("*").alias(name)).where(F.col(name) > 1)
