"""Join to the periods in force where a key may have very many of them.

Equal keys with the range as a residual condition compare each row with every
period of its key. Here days and periods meet in bins instead: a period goes to the
bins of the level whose width is that of its own length, two at most, a day to its
one bin of each level that occurs, some twenty at most. What meets is of the
size of what matches, within a small factor, and the exact range decides.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import OPEN_END
from .joins import lookup_join


def _day(c: Column) -> Column:
    return F.unix_date(c.cast("date"))


def interval_join(
    left: DataFrame,
    periods: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str = "effective_from",
    end: str = "effective_to",
    spread: Sequence[str] = (),
    hot: Sequence[int] = (),
) -> DataFrame:
    """Left join to the periods that hold on a row's day, as ``effective_join`` does.

    Each pair of key and day is looked up once, however many rows have it, and the
    rows then join by equal key and day: a key that holds a third of the rows is cut
    by its days, and no row is copied. Rows with a null key or day match nothing;
    a null end is open; overlapping periods yield one row each.
    """
    until = F.coalesce(F.col(end), F.lit(OPEN_END).cast("date"))
    held = periods.dropna(subset=[*keys, start]).where(until >= F.col(start))
    first, last = _day(F.col(start)), _day(until)
    # Bins of a level are at least as wide as its periods are long.
    level = F.ceil(F.log2((last - first + 1).cast("double"))).cast("int")
    cut = held.withColumns({"_level": level, "_first": first, "_last": last})
    # As many numbers as there are lengths of periods by powers of two.
    levels = [r[0] for r in cut.select("_level").distinct().collect()]
    bins = F.array_distinct(F.array(F.expr("shiftright(_first, _level)"), F.expr("shiftright(_last, _level)")))
    placed = cut.withColumn("_bin", F.explode(bins))
    days = left.select(*keys, F.col(at).cast("date").alias("_at")).dropna().distinct()
    every = days.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
    asked = every.withColumn("_bin", F.expr("shiftright(unix_date(_at), _level)"))
    within = (F.col("_at") >= F.col(start)) & (F.col("_at") <= until)
    on = {**{k: k for k in keys}, "_level": "_level", "_bin": "_bin"}
    met = lookup_join(asked, placed, on, "inner", within).drop("_level", "_bin", "_first", "_last", start, end)
    dated = left.withColumn("_day", F.col(at).cast("date"))
    return lookup_join(dated, met, {**{k: k for k in keys}, "_day": "_at"}, "left", None, spread, hot).drop("_day")
