"""File scans and sinks."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.shape import conform
from ..session import open_writers

_PART = "part_"
# Rows of a part that one task writes on.
_TASK = 1_000_000


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def empty_files(spark: SparkSession, folder: str, glob: str) -> list[str]:
    """Paths of the files without content, which Spark's readers pass over."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{glob}")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    return [s.getPath().toString() for s in found if s.isFile() and not s.getLen()]


def remove_others(spark: SparkSession, folder: str, prefix: str, named: set[str]) -> int:
    """Delete the parts of a folder's versions that are not named; their number.

    A version folder is either named itself or holds slice folders that are.
    """
    Path = spark._jvm.org.apache.hadoop.fs.Path
    top = Path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for version in fs.listStatus(top) if fs.exists(top) else []:
        name = f"{prefix}{version.getPath().getName()}"
        if name in named:
            continue
        if not any(n.startswith(f"{name}/") for n in named):
            gone += fs.delete(version.getPath(), True)
            continue
        for part in fs.listStatus(version.getPath()):
            inner = f"{name}/{part.getPath().getName()}"
            if part.isDirectory() and inner not in named:
                gone += fs.delete(part.getPath(), True)
    return gone


def csv_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and quoted fields, read with a given schema."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )


def incremental_scan(
    df: DataFrame, mark: Column, column: str = "updated_at"
) -> DataFrame:
    """Rows changed after a mark; a literal mark reaches the Parquet reader."""
    return df.where(F.col(column) > mark)


def land(df: DataFrame, folder: str, column: str = "updated_at", part: Column | None = None, mode: str = "overwrite") -> dict:
    """Write one batch as Parquet; its row count and mark come from the write.

    Overwriting the batch's own folder makes a repeated run harmless. ``part``: rows go
    to a folder for each of its values, see ``Parted``; none is moved to another task.
    """
    seen = Observation()
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max(column).alias("mark")
    )
    if part is None:
        watched.write.mode(mode).option("compression", "zstd").parquet(folder)
        return seen.get
    named = watched.withColumn(_PART, F.coalesce(part.cast("string"), F.lit("none")))
    with open_writers(df.sparkSession):
        named.write.mode(mode).option("compression", "zstd").partitionBy(_PART).parquet(folder)
    return seen.get


@dataclass(frozen=True)
class Parted:
    """Rows that were landed by parts: by hash of a key, to meet a reference part by part,
    or by slice, to be gathered. The files take a quarter of the bytes of an exchange."""

    spark: SparkSession
    folder: str
    schema: T.StructType

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder).select(*self.schema.names)

    def only(self, part: int | str) -> DataFrame:
        path = f"{self.folder}/{_PART}={part}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(path)

    def gathered(self) -> DataFrame:
        """All rows, each task's of one part: many small files become few without an exchange."""
        tagged = T.StructType([*self.schema, T.StructField(_PART, T.StringType())])
        counts = self.spark.read.schema(tagged).parquet(self.folder).groupBy(_PART).count().collect()
        # Never one task: a union of parts of one task each would be one task itself.
        pieces = [self.only(r[_PART]).coalesce(2 + r["count"] // _TASK) for r in sorted(counts)]
        return reduce(DataFrame.union, pieces) if pieces else self.spark.createDataFrame([], self.schema)


def load_by_name(
    spark: SparkSession, folder: str, target: T.StructType
) -> DataFrame:
    """Landed Parquet in the target's columns, matched by name in any case."""
    return conform(spark.read.parquet(folder), target)


def append_rows(df: DataFrame, path: str) -> int:
    """Append and say how many rows went in, without a second scan."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]
