"""What an incremental model adds to its target."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregates import high_water_mark


# Feeds that a column may name; each has a mark of its own.
FEEDS = 1000


def incremental_rows(
    df: DataFrame,
    target: DataFrame | None = None,
    column: str = "updated_at",
    mark: Column | None = None,
    lateness: str | None = None,
    by: str | None = None,
) -> DataFrame:
    """Rows changed after the target's high-water mark.

    Strictly after: a row that equals the mark, or that arrives later with an
    older change time, is *not* picked up. That is the default rule. Two
    options soften it:

    lateness  look back by an interval such as ``2 days``; safe before a keyed
              upsert, which makes re-read rows harmless
    by        keep one mark per value of a column that names a few feeds (for
              example ``source_system``), so that one cannot hide another's rows

    ``mark`` gives the mark as a value (from a ledger or a table's manifest) and
    saves the scan of the target.
    """
    back = F.expr(f"interval {lateness}") if lateness else None
    if by is not None:
        # The marks become one map value. A join to them might be planned as a
        # shuffle of all rows on a column with only a few values.
        feed = F.coalesce(F.col(by).cast("string"), F.lit(""))
        marks = target.groupBy(feed.alias("feed")).agg(F.max(column).alias("mark"))
        few = marks.limit(FEEDS + 1).collect()
        if len(few) > FEEDS:
            raise ValueError(f"{by} names more than {FEEDS} feeds")
        if not few:
            return df
        by_feed = F.create_map(*[F.lit(v) for r in few for v in (r.feed, r.mark)])
        since = F.try_element_at(by_feed, feed)
        since = since if back is None else since - back
        return df.where(since.isNull() | (F.col(column) > since))
    if mark is None:
        mark = high_water_mark(target, column).scalar()
    return df.where(F.col(column) > (mark if back is None else mark - back))


def reconcile(
    target: DataFrame, source: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Both sides in the source's columns: new ones are null in the target,
    vanished ones are dropped from it. Types follow the source."""
    have = {c.lower(): c for c in target.columns}

    def column(f: T.StructField) -> Column:
        if f.name.lower() in have:
            return F.col(have[f.name.lower()]).cast(f.dataType).alias(f.name)
        return F.lit(None).cast(f.dataType).alias(f.name)

    return target.select(*[column(f) for f in source.schema]), source
