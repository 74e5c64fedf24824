"""Sales files dropped by resellers.

All unseen files are read in one distributed scan; the driver handles one row
per file (name, size, fingerprint), never file content.
"""

import csv
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import DROP_HEADERS, FILE_NAME_STRICT, SYSTEM_FILES
from ..functions.dates import try_date
from ..functions.filenames import drop_file_date, drop_file_reseller
from ..operators.joins import lookup_join
from ..operators.rejects import reject_reason, split_rejects
from ..operators.shape import add_missing_columns, conform, rename_columns, stamp
from ..schemas import DAILY_SALES, FILE_HISTORY, POSITIONAL_DROP
from .files import append_rows, empty_files
from .ledgers import Ledger, Ledgers
from .tables import VersionedTable

CSV_GLOB = "*.[cC][sS][vV]"
_BAD = "_corrupt_record"
DROP_TEXT = T.StructType(
    [T.StructField(c, T.StringType()) for c in DROP_HEADERS.values()]
)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Name, path, size and modification time of each CSV in a folder, empty ones too
    (without a time); reads no content."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", CSV_GLOB).load(folder)
    ).select("path", "length", F.col("modificationTime").cast("timestamp_ntz").alias("modified"))
    empty = [(p, 0, None) for p in empty_files(spark, folder, CSV_GLOB)]
    files = files.unionByName(
        spark.createDataFrame(empty, "path string, length long, modified timestamp_ntz")
    )
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        "modified",
    )


def _bare(path: str) -> Column:
    """A path without the scheme of local files, which readers write differently."""
    return F.regexp_replace(path, "^file:/+", "/")


def known_fingerprints(
    spark: SparkSession, folder: str, known: Ledger
) -> DataFrame:
    """What ``fingerprint`` says, in two steps: a file whose path, size and
    modification time are in the ledger ``known`` is not opened, its hash is taken
    from there. Those of the others are added to it.

    A file that is written again with another content of the same size within the
    clock tick of its file system would be taken for the old one.
    """
    listed = list_files(spark, folder)
    on = {c: c for c in ("file_path", "file_size", "modified")}
    timed = listed.where(F.col("modified").isNotNull())
    unknown = lookup_join(timed, known.read().select(*on), on, "left_anti")
    paths = [r.file_path for r in unknown.select("file_path").collect()]  # one row per new file
    if paths:
        hashed = fingerprint(spark, folder, paths).select("file_path", "file_sha", "header")
        new = conform(lookup_join(timed, hashed, {"file_path": "file_path"}, "inner"), known.schema)
        append_rows(new.coalesce(1), known.path)
    told = lookup_join(timed, known.read().dropDuplicates(list(on)), on, "inner").drop("modified")
    empty = [r.file_path for r in listed.where(F.col("modified").isNull()).select("file_path").collect()]
    return told.unionByName(fingerprint(spark, folder, empty)) if empty else told


def fingerprint(
    spark: SparkSession, folder: str, paths: Sequence[str] | None = None
) -> DataFrame:
    """Name, path, size, content hash and header line of each CSV in a folder, or of
    some of them.

    One rule at every size: a line's hash covers its number in the file, the sum
    of them and the file's size make the file's hash. No file is held in one row,
    and how a file is cut for reading does not matter. Lines are numbered by the
    line counts of the blocks before. A file without content has a null header.
    """
    files = list_files(spark, folder).drop("modified")
    if paths is not None:
        one = spark.createDataFrame([(p,) for p in paths], "path string")
        named = files.withColumn("path", _bare("file_path"))
        files = lookup_join(named, one.select(_bare("path").alias("path")), {"path": "path"}, "left_semi").drop("path")
    lines = (
        spark.read.option("pathGlobFilter", CSV_GLOB)
        .text(folder if paths is None else list(paths))
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("at"),
            "value",
        )
    )
    blocks = lines.groupBy("file_path", "start").agg(
        F.min("at").alias("first"), F.count("*").alias("n")
    )
    before = Window.partitionBy("file_path").orderBy("start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = blocks.select(
        "file_path", "start",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    numbered = lines.join(offsets, ["file_path", "start"]).withColumn(
        "line", F.col("at") + F.col("shift")
    )
    hashes = [
        F.sum(F.xxhash64(F.lit(seed), "line", "value").cast("decimal(38,0)"))
        for seed in (1, 2)
    ]
    contents = numbered.groupBy("file_path").agg(
        F.concat_ws("/", *[h.cast("string") for h in hashes]).alias("sums"),
        F.max(F.when(F.col("line") == 0, F.col("value"))).alias("header"),
    )
    return (
        files.withColumn("key", _bare("file_path"))
        .join(contents.select(_bare("file_path").alias("key"), "sums", "header"), "key", "left")
        .select(
            "file_name", "file_path", "file_size",
            F.sha1(F.concat_ws("/", F.col("file_size").cast("string"), "sums")).alias("file_sha"),
            "header",
        )
    )


def unseen_files(files: DataFrame, history: DataFrame, by_name: bool = True) -> DataFrame:
    """Files that no successful load covers, all decided in one join.

    A file counts as seen if its name and content hash were loaded, or with
    ``by_name=False`` if its content was, under whatever name.
    """
    keys = ["file_name", "file_sha"] if by_name else ["file_sha"]
    done = history.where(F.col("status") == "SUCCESS")
    return lookup_join(files, done, {k: k for k in keys}, "left_anti")


def _read_layout(
    spark: SparkSession, paths: list[str], header: list[str], multi_line: bool
) -> DataFrame:
    """Files that share a header, every field as text, bad lines kept aside."""
    fields = [T.StructField(h, T.StringType()) for h in header]
    fields.append(T.StructField(_BAD, T.StringType()))
    return (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .option("columnPruning", False)
        .csv(paths)
        .withColumn("source_file_name", F.col("_metadata.file_name"))
        .transform(_to_target)
    )


def _row_rules(target: T.StructType, named: list[str]) -> dict[str, Column]:
    """A line must fit the layout and each text the target's type.

    Fields are read as text and tested here, not typed by the CSV reader: that
    converts only the columns a query asks for, so whether a row counts as bad
    would depend on the query.
    """
    rules = {"malformed line": F.col(_BAD).isNotNull()}
    for field in target:
        if field.name in named and field.dataType != T.StringType():
            raw = F.col(field.name)
            fits = (
                try_date(raw)
                if field.dataType == T.DateType()
                else raw.try_cast(field.dataType)
            )
            rules[f"bad {field.name}"] = raw.isNotNull() & fits.isNull()
    return rules


def _to_target(rows: DataFrame) -> DataFrame:
    """Business headers renamed, absent columns null, others left out."""
    named = add_missing_columns(rename_columns(rows, DROP_HEADERS), DROP_TEXT)
    return named.select(*DROP_TEXT.fieldNames(), _BAD, "source_file_name")


def drop_rows(
    rows: DataFrame, pattern: str, batch_id: str, run_ts: Column
) -> tuple[DataFrame, dict[str, Column]]:
    """Text rows with load metadata, and the rules a good row keeps."""
    stamped = stamp(
        rows,
        batch_id,
        SYSTEM_FILES,
        run_ts,
        source_file=F.col("source_file_name"),
        reseller=drop_file_reseller("source_file_name", pattern),
    )
    rules = {
        **_row_rules(DAILY_SALES, DROP_TEXT.fieldNames()),
        "missing transaction_id": F.col("transaction_id").isNull(),
    }
    return stamped, rules


def _header(line: str | None) -> tuple[str, ...]:
    return tuple(next(csv.reader([(line or "").strip("\ufeff\r\n")]), []))


def header_fault(line: str | None) -> str | None:
    """Why a file cannot be read by its header line, or None."""
    if line is None:
        return "Empty file"
    names = _header(line)
    if not any(n.strip() for n in names):
        return "Blank header line"
    folded = [n.lower() for n in names]
    twice = sorted({n for n in names if folded.count(n.lower()) > 1})
    if twice:
        return f"Repeated column: {', '.join(twice)}"
    if not set(folded) & {h.lower() for h in DROP_HEADERS}:
        return "No known column"
    return None


class DropFeed:
    """Loads unseen files into an append-only table and keeps the file ledger."""

    def __init__(
        self,
        spark: SparkSession,
        table: VersionedTable,
        ledgers: Ledgers,
        pattern: str = FILE_NAME_STRICT,
        dated: bool = True,
        on_bad_rows: str = "reject",
        multi_line: bool = True,
        by_name: bool = True,
        log_skipped: bool = False,
    ):
        """
        pattern      rule for file names; ``dated``: its date must exist
        on_bad_rows  ``reject`` loads the good rows of a file and sets the bad ones
                     aside; ``fail_file`` loads nothing of a file with a bad row
        multi_line   keep quoted line breaks; without it a large file is read in parts
        by_name      a known file is known by name and content, or by content alone
        log_skipped  known files get a ledger row as well
        """
        if on_bad_rows not in ("reject", "fail_file"):
            raise ValueError(on_bad_rows)
        self.spark, self.table, self.ledgers = spark, table, ledgers
        self.pattern, self.dated = pattern, dated
        self.on_bad_rows, self.multi_line = on_bad_rows, multi_line
        self.by_name, self.log_skipped = by_name, log_skipped

    def parse(
        self, files: list[Row], batch_id: str, run_ts: Column
    ) -> tuple[DataFrame, dict[str, Column]]:
        """Rows of the files in target columns as text, and the row rules."""
        layouts = defaultdict(list)
        for f in files:
            layouts[_header(f.header)].append(f.file_path)
        whole = None
        for header, paths in layouts.items():
            part = _read_layout(self.spark, paths, list(header), self.multi_line)
            whole = part if whole is None else whole.unionByName(part)
        return drop_rows(whole, self.pattern, batch_id, run_ts)

    def loaded(self) -> DataFrame:
        """Ledger rows of the files whose rows are in the table now. They are part
        of the table's commits, so a run that died after one is not repeated, and
        emptying the table forgets them."""
        return self.table.beside(FILE_HISTORY)

    def _catch_up(self) -> None:
        """Files of a run that died between its commit and the ledger."""
        known = self.ledgers.files.read().where("status = 'SUCCESS'")
        keys = {k: k for k in ("file_name", "file_sha", "load_date")}
        missing = lookup_join(self.loaded(), known, keys, "left_anti")
        if not missing.isEmpty():
            self.ledgers.files.append(missing)

    def load(self, folder: str, batch_id: str, run_ts: Column) -> dict:
        """Load what is new in a folder; each file succeeds or fails on its own."""
        self._catch_up()
        found = known_fingerprints(self.spark, folder, self.ledgers.seen)
        fresh = unseen_files(found, self.loaded(), self.by_name)
        if not self.by_name:
            # Equal files of one run: the first by name is loaded.
            first = Window.partitionBy("file_sha").orderBy("file_name")
            fresh = fresh.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
        if self.log_skipped:
            known = lookup_join(found, fresh, {"file_path": "file_path"}, "left_anti")
            self.ledgers.files.append(
                known.select(
                    "file_name",
                    "file_sha",
                    run_ts.alias("load_date"),
                    F.lit(0).alias("record_count"),
                    F.lit("SKIPPED").alias("status"),
                    F.lit("File already processed").alias("error_message"),
                )
            )
        valid = drop_file_reseller("file_name", self.pattern).isNotNull()
        if self.dated:
            valid = valid & drop_file_date("file_name", self.pattern).isNotNull()
        # One row per new file.
        files = fresh.withColumn("valid", valid).collect()
        faults = {
            f.file_name: header_fault(f.header) if f.valid else f"Invalid file name: {f.file_name}"
            for f in files
        }
        failed = {name: why for name, why in faults.items() if why}
        named = [f for f in files if f.file_name not in failed]
        loaded, rejected = {}, 0
        if named:
            rows, rules = self.parse(named, batch_id, run_ts)
            reason = reject_reason(rules)
            if self.on_bad_rows == "fail_file":
                broken = rows.where(reason.isNotNull()).groupBy("source_file_name")
                for r in broken.agg(F.min(reason).alias("why")).collect():
                    failed[r.source_file_name] = r.why
                if failed:
                    bad = self.spark.createDataFrame([(n,) for n in failed], "name string")
                    rows = lookup_join(rows, bad, {"source_file_name": "name"}, "left_anti")
            seen = Observation()
            tagged = rows.withColumn("_reason", reason).observe(
                seen, F.count(F.col("_reason")).alias("bad")
            )
            good = tagged.where(F.col("_reason").isNull())
            entries = self._entries([f for f in named if f.file_name not in failed], {}, run_ts)

            def counted(written: DataFrame) -> DataFrame:
                counts = written.groupBy(F.col("source_file_name").alias("file_name")).agg(
                    F.count("*").alias("n")
                )
                return conform(
                    lookup_join(entries, counts, {"file_name": "file_name"}).withColumn(
                        "record_count", F.coalesce("n", F.lit(0))
                    ),
                    FILE_HISTORY,
                )

            self.table.append(conform(good, DAILY_SALES), counted)
            rejected = seen.get["bad"]
            if rejected:
                _, bad = split_rejects(
                    rows, rules, batch_id, "reseller_daily_sales", run_ts, "source_file_name"
                )
                self.ledgers.rejects.append(bad)
            self._catch_up()
            done = lookup_join(self.loaded(), entries, {"file_name": "file_name", "file_sha": "file_sha"}, "left_semi")
            loaded = {r.file_name: r.record_count for r in done.collect()}
        lost = [f for f in files if f.file_name in failed]
        if lost:
            self.ledgers.files.append(self._entries(lost, failed, run_ts))
        return {
            "files": len(files) - len(failed),
            "failed": len(failed),
            "rows": sum(loaded.values()),
            "rejected": rejected,
        }

    def _entries(self, files: list[Row], failed: dict, run_ts: Column) -> DataFrame:
        rows = [
            (
                f.file_name, f.file_sha, None, 0,
                "FAILED" if f.file_name in failed else "SUCCESS",
                failed.get(f.file_name),
            )
            for f in files
        ]
        return self.spark.createDataFrame(rows, FILE_HISTORY).withColumn("load_date", run_ts)


def positional_drops(
    spark: SparkSession,
    path: str,
    batch_id: str,
    run_ts: Column,
    schema: T.StructType = POSITIONAL_DROP,
) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects of exports whose columns count by position.

    Lines that do not fit the types are set aside and the load goes on.
    """
    text = [T.StructField(f.name, T.StringType()) for f in schema]
    rows = (
        spark.read.schema(T.StructType([*text, T.StructField(_BAD, T.StringType())]))
        .option("header", True)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", _BAD)
        .option("columnPruning", False)
        .option("pathGlobFilter", CSV_GLOB)
        .csv(path)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )
    rules = _row_rules(schema, schema.fieldNames())
    good, rejects = split_rejects(
        rows, rules, batch_id, "reseller_exports", run_ts, "file_name"
    )
    loaded = good.select(
        *[F.col(f.name).cast(f.dataType) for f in schema],
        "file_name",
        drop_file_date("file_name").alias("file_sale_date"),
        F.lit(batch_id).alias("batch_id"),
        run_ts.alias("load_ts"),
    )
    return loaded, rejects
