"""Counts, totals, duplicates, marks and rankings."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import EPOCH_MARK


def labelled_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    rows = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def duplicate_keys(
    df: DataFrame,
    keys: Sequence[str],
    skip_nulls: bool = False,
    name: str = "duplicate_count",
) -> DataFrame:
    """Keys that occur more than once, with their count."""
    if skip_nulls:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}")
    )


def high_water_mark(df: DataFrame, column: str = "updated_at") -> DataFrame:
    """Largest change time, the start of time where there is none."""
    epoch = F.lit(EPOCH_MARK).cast("timestamp_ntz")
    return df.agg(F.coalesce(F.max(column), epoch).alias(column))


def totals(
    df: DataFrame, by: Sequence[Column | str], measures: Mapping[str, Column]
) -> DataFrame:
    """Grouped totals; partial sums are formed before the exchange."""
    return df.groupBy(*by).agg(*[m.alias(n) for n, m in measures.items()])


def filtered_totals(
    df: DataFrame, measure: Column, conditions: Mapping[str, Column]
) -> DataFrame:
    """Several filtered sums of one measure in a single pass."""
    return df.agg(
        *[F.sum(F.when(c, measure)).alias(n) for n, c in conditions.items()]
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of an order; each task keeps ``k`` rows at most."""
    return df.orderBy(*order).limit(k)


def top_k_per(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
) -> DataFrame:
    """The first ``k`` rows of each group, pruned per task before the exchange."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
