"""Files derived from the given tables, for the queries that read files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import DROP_HEADERS
from ..session import scratch_dir
from .domain import Domain


def _rename_parts(spark: SparkSession, folder: str, target: str) -> None:
    """Give the one part file of each day the name a reseller would."""
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(Path(target))
    for status in fs.globStatus(Path(f"{folder}/file=*/part-*.csv")):
        part = status.getPath()
        name = part.getParent().getName().split("=", 1)[1]
        if not fs.rename(part, Path(f"{target}/{name}.csv")):
            raise OSError(f"two parts for {name}")


def daily_with_headers(domain: Domain) -> DataFrame:
    """Daily sales under the business headers of a drop file."""
    daily = domain.reseller_daily_sales()
    return daily.select(*[F.col(c).alias(h) for h, c in DROP_HEADERS.items()])


def export_drops(spark: SparkSession, folder: str, foreign: int = 0) -> str:
    """All events as drop files, one per day; returns the folder. Files of the first
    ``foreign`` days of a month get a name that no drop file has."""
    daily = Domain(spark, folder).reseller_daily_sales()
    day = F.col("created_date").cast("date")
    file = F.concat(
        F.when(F.dayofmonth(day) <= foreign, "Sales_").otherwise("DailySales_"),
        F.date_format(day, "MMddyyyy"), F.lit("_RES"),
        F.lpad(F.dayofmonth(day).cast("string"), 3, "0"),
    )
    rows = daily.select(
        *[F.col(c).alias(h) for h, c in DROP_HEADERS.items()], file.alias("file")
    )
    written = scratch_dir(spark, "drops-parts")
    (
        rows.repartition("file")
        .write.partitionBy("file")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(written)
    )
    target = scratch_dir(spark, "drops")
    _rename_parts(spark, written, target)
    return target


def export_positional(spark: SparkSession, folder: str) -> str:
    """All events in the 16-column layout, a file for each day; error events carry
    a quantity that is no number."""
    events = Domain(spark, folder)("events")
    rows = events.select(
        F.concat(F.lit("DailySales_"), F.date_format("ts", "MMddyyyy"), F.lit("_R001")).alias("file"),
        F.col("ts").cast("date").cast("string").alias("sale_date"),
        F.concat(F.lit("R"), "user_id").alias("reseller_id"),
        F.lit("Seller, Ltd").alias("reseller_name"),
        F.lit("Europe").alias("reseller_region"),
        "event_id",
        F.concat(F.lit("Show "), "event_id").alias("event_name"),
        "event_type",
        F.lit(5001).alias("ticket_type_id"),
        F.lit("VIP").alias("ticket_name"),
        F.lit("WEB").alias("sales_channel"),
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(F.expr("CAST(event_id % 7 AS STRING)"))
        .alias("quantity"),
        F.col("value").cast("decimal(12,2)").alias("unit_price"),
        F.col("value").cast("decimal(12,2)").alias("gross_amount"),
        F.lit("10.00").alias("commission_rate"),
        F.lit("someone@example.org").alias("customer_email"),
        F.lit("USD").alias("currency"),
    )
    written = scratch_dir(spark, "positional-parts")
    rows.repartition("file").write.partitionBy("file").option("header", True).csv(written)
    target = scratch_dir(spark, "positional")
    _rename_parts(spark, written, target)
    return target
