"""The file feed as a stream: the checkpoint remembers which files were read, and its
state which transactions were loaded."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..fixed import DROP_HEADERS, FILE_NAME_STRICT
from ..functions.filenames import drop_file_reseller
from ..operators.joins import lookup_join
from ..operators.rejects import reject_reason, split_rejects
from ..operators.shape import conform
from ..schemas import DAILY_SALES, FILE_HISTORY
from ..sources.drops import _BAD, _to_target, CSV_GLOB, drop_rows, fingerprint
from ..sources.ledgers import Ledgers

_LAYOUT = T.StructType(
    [T.StructField(h, T.StringType()) for h in [*DROP_HEADERS, _BAD]]
)
_NAMED = "invalid file name"


def stream_drops(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    run_ts: Column,
    pattern: str = FILE_NAME_STRICT,
    files_per_batch: int = 10_000,
    ledgers: Ledgers | None = None,
    remember: str = "400 days",
) -> StreamingQuery:
    """Load all files that are new since the last run, then stop.

    Good rows go to ``target/rows/epoch=<n>``, bad rows and rows of files with a
    foreign name to ``target/rejects/epoch=<n>``, row counts per file to
    ``target/files/epoch=<n>``, and to ``target/history/epoch=<n>`` the file history:
    name, content hash, rows loaded, SUCCESS or FAILED. With ``ledgers`` the history
    also goes to their file ledger, each file and content once. A micro-batch that is
    repeated after a failure overwrites its own folders, so each file counts once.
    Files must carry the standard header; another one stops the stream instead of
    shifting columns.

    A transaction is loaded once: its id stays in the stream's state for ``remember``
    after it came, so a file that is sent again under any name, or a row repeated in
    another file, adds nothing. Rejected rows are not remembered; a mended one is loaded.
    """
    source = (
        spark.readStream.schema(_LAYOUT)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", _BAD)
        .option("columnPruning", False)
        .option("pathGlobFilter", CSV_GLOB)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
        .withColumn("source_file_name", F.col("_metadata.file_name"))
    )

    def judged(rows: DataFrame, batch_id: str) -> tuple[DataFrame, dict[str, Column]]:
        stamped, rules = drop_rows(rows, pattern, batch_id, run_ts)
        return stamped, {_NAMED: F.col("reseller_id").isNull(), **rules}

    text = _to_target(source)
    stamped, rules = judged(text, "stream")
    # Of bad rows only a line that is repeated within its file is one line.
    line = F.concat_ws("/", F.lit("line"), "source_file_name", F.xxhash64(*text.columns))
    number = F.col("transaction_id").try_cast("decimal(38,0)").cast("string")
    told = stamped.select(
        *text.columns,
        F.when(reject_reason(rules).isNull(), number).otherwise(line).alias("_told"),
        # When the row came: the batch's own time, so none is ever late.
        F.current_timestamp().alias("_came"),
    )
    once = told.withWatermark("_came", remember).dropDuplicatesWithinWatermark(["_told"])

    def write(batch: DataFrame, epoch: int) -> None:
        here = batch.sparkSession
        part = f"epoch={epoch}"
        # Read several times below: once more from the state would give other rows.
        batch.select(*text.columns).write.mode("overwrite").parquet(f"{target}/text/{part}")
        batch = here.read.schema(text.schema).parquet(f"{target}/text/{part}")
        rows, rules = judged(batch, f"epoch-{epoch}")
        good, bad = split_rejects(
            rows, rules, f"epoch-{epoch}", "reseller_daily_sales", run_ts, "source_file_name"
        )
        conform(good, DAILY_SALES).write.mode("overwrite").parquet(f"{target}/rows/{part}")
        bad.write.mode("overwrite").parquet(f"{target}/rejects/{part}")
        loaded = here.read.schema(DAILY_SALES).parquet(f"{target}/rows/{part}")
        counts = loaded.groupBy(F.col("source_file_name").alias("file_name")).agg(
            F.count("*").alias("record_count")
        )
        counts.write.mode("overwrite").parquet(f"{target}/files/{part}")
        _record(here, batch, counts, f"{target}/history/{part}")

    def _record(here: SparkSession, batch: DataFrame, counts: DataFrame, path: str) -> None:
        named = batch.select(F.col("source_file_name").alias("file_name")).distinct()
        names = [r.file_name for r in named.collect()]  # as many as a batch has files
        if not names:
            return
        found = fingerprint(here, folder, [f"{folder}/{n}" for n in names])
        of_file = lookup_join(found, counts, {"file_name": "file_name"})
        strange = drop_file_reseller("file_name", pattern).isNull()
        entries = of_file.withColumns(
            {
                "load_date": run_ts,
                "record_count": F.coalesce("record_count", F.lit(0)),
                "status": F.when(strange, "FAILED").otherwise("SUCCESS"),
                "error_message": F.when(strange, F.concat(F.lit("Invalid file name: "), "file_name")),
            }
        )
        conform(entries, FILE_HISTORY).coalesce(1).write.mode("overwrite").parquet(path)
        if ledgers:
            written = here.read.schema(FILE_HISTORY).parquet(path)
            keys = {k: k for k in ("file_name", "file_sha", "status")}
            missing = lookup_join(written, ledgers.files.read(), keys, "left_anti")
            if not missing.isEmpty():
                ledgers.files.append(missing)

    return (
        once.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
