"""Append-only ledgers: watermarks, file history, seen files, job audit, rejects, checks."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..fixed import EPOCH_MARK
from ..operators.latest import latest_by
from ..operators.shape import conform
from .files import exists


class Ledger:
    """One Parquet dataset that only grows.

    ``brief``: an append is a handful of rows (a row per table, file or check) and
    becomes one file; rejects are data and keep their partitions.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, brief: bool = True
    ):
        self.spark, self.path, self.schema, self.brief = spark, path, schema, brief

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def append(self, df: DataFrame) -> None:
        rows = conform(df, self.schema)
        if self.brief:
            rows = rows.coalesce(1)
        rows.write.mode("append").parquet(self.path)

    def add(self, **values) -> None:
        """Append one row; columns not named are null."""
        one = self.spark.range(1).select(
            *[
                (v if isinstance(v, Column) else F.lit(v)).alias(k)
                for k, v in values.items()
            ]
        )
        self.append(one)


class Ledgers:
    """The ledgers of one pipeline, under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        root = root.rstrip("/")
        self.watermarks = Ledger(spark, f"{root}/watermarks", schemas.WATERMARKS)
        self.files = Ledger(spark, f"{root}/file_history", schemas.FILE_HISTORY)
        self.seen = Ledger(spark, f"{root}/seen_files", schemas.SEEN_FILES)
        self.jobs = Ledger(spark, f"{root}/job_audit", schemas.JOB_AUDIT)
        self.rejects = Ledger(spark, f"{root}/rejects", schemas.REJECTS, brief=False)
        self.checks = Ledger(spark, f"{root}/check_log", schemas.CHECK_LOG)

    def watermark(self, table: str) -> Column:
        """Last mark of a table as a literal; the start of time if it has none."""
        row = (
            current_watermarks(self.watermarks.read())
            .where(F.col("source_table") == F.lit(table))
            .first()
        )
        mark = row.last_updated_at if row else None
        return F.lit(EPOCH_MARK if mark is None else mark).cast("timestamp_ntz")

    def set_watermark(self, table: str, mark, batch_id: str, run_ts: Column) -> None:
        self.watermarks.add(
            source_table=table,
            last_updated_at=mark,
            updated_ts=run_ts,
            batch_id=batch_id,
        )


def current_watermarks(ledger: DataFrame) -> DataFrame:
    """Latest entry per table. Entries are appended, so a table that was never
    tracked is tracked from its first entry on."""
    newest = [F.col("updated_ts").desc(), F.col("last_updated_at").desc_nulls_last()]
    return latest_by(ledger, ["source_table"], newest)


def new_watermarks(
    table: str, delta: DataFrame, batch_id: str, run_ts: Column
) -> DataFrame:
    """Ledger row of a loaded batch: the largest change time it brought."""
    return delta.agg(F.max("updated_at").alias("last_updated_at")).select(
        F.lit(table).alias("source_table"),
        "last_updated_at",
        run_ts.alias("updated_ts"),
        F.lit(batch_id).alias("batch_id"),
    )
