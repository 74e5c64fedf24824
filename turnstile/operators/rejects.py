"""Bad rows go to a reject set instead of failing the load."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shape import conform
from ..schemas import REJECTS


def reject_reason(rules: Mapping[str, Column]) -> Column:
    """Name of the first rule a row breaks, null for a good row."""
    return F.coalesce(*[F.when(c, F.lit(n)) for n, c in rules.items()])


def split_rejects(
    df: DataFrame,
    rules: Mapping[str, Column],
    batch_id: str,
    source_name: str,
    run_ts: Column,
    source_file: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Good rows as they are, bad rows with a reason and their content as JSON."""
    tagged = df.withColumn("_reason", reject_reason(rules))
    good = tagged.where(F.col("_reason").isNull()).drop("_reason")
    bad = tagged.where(F.col("_reason").isNotNull()).select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(source_name).alias("source_name"),
        (F.col(source_file) if source_file else F.lit(None)).alias("source_file"),
        F.col("_reason").alias("reason"),
        F.to_json(
            F.struct(*[F.col(f"`{c}`") for c in df.columns]),
            {"ignoreNullFields": "false"},
        ).alias("raw_payload"),
        run_ts.alias("rejected_at"),
    )
    return good, conform(bad, REJECTS)
