"""Tables of Parquet files that are published version by version.

Plain Parquet has no MERGE and must not be overwritten while it is read. Each
change therefore writes new files beside the old ones and then appends one small
manifest file that names the folders of the new version. Readers see the last
complete manifest; a job that dies before it leaves the old version in force.
One writer per table is assumed.

A change is first a draft: its files are written and can be read and checked, but
no reader sees them before it is committed. Tables that share a ``Commits`` record
are committed together.

A table may be cut into slices by an expression over its rows (a month, a bucket
of the key). An upsert rewrites only the slices that hold a changed key or get a
new row; the other slices are carried over by name, not copied. Which slices hold a
key is told by a directory of keys, if the table keeps one: small files by hash
bucket of the key that grow with each commit, of which a change reads its own buckets.
With a directory a slice that only gets new rows is not rewritten either: they come
in a folder of their own. Of rewritten slices only rows that change are moved.
"""

import json
from collections import Counter
from collections.abc import Callable, Hashable, Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import EPOCH_MARK
from ..operators import joins
from ..operators.aggregates import duplicate_keys
from ..operators.incremental import reconcile
from ..operators.joins import copied_if_small, lookup_join
from ..operators.upsert import HASH, MergeConflict, apart, apply_upsert, key_hashes, merge_conflicts, shared_hashes, upsert_parts
from ..schemas import fields
from ..session import open_writers, scratch_dir
from .commits import Commits
from .files import append_rows, exists, remove_others

_MANIFEST = fields(
    "version bigint, slice string, folder string, rows bigint, mark timestamp_ntz, "
    "schema string"
)
_SLICE = "slice_"
# Manifest entry of rows that a commit brings beside the table's own.
_BESIDE = "beside"
# Manifest entries of the key directory, by bucket, and its columns.
_KEYS, _BUCKET = "keys/", "bucket_"
_DIRECTORY = fields("key_hash bigint, slice string")
# Files of a bucket of the directory, or folders of a slice; beyond, they are made one.
_COMPACT = 8
# Rows of a stored file under which a slice of many files is gathered anew.
_FULL_FILE = 100_000
# What a hash measures when it is copied.
_HASH_BYTES = 16
# Keys and md5 texts take half the room that they take by Spark's default.
_CODEC = "zstd"


def _is_data(r: Row) -> bool:
    return r.slice != _BESIDE and not r.slice.startswith(_KEYS)


@dataclass(frozen=True)
class Slices:
    """How a table is cut. ``by_key``: a row's slice follows from its key, so an
    upsert finds the slices of a delta without looking at the stored rows.
    ``column`` and ``pattern``: the slice's name is that column's date, formatted,
    so that a span of dates names its slices."""

    value: Column
    by_key: bool = False
    column: str = ""
    pattern: str = ""


def key_buckets(keys: Sequence[str], buckets: int) -> Slices:
    """Hash buckets of the key."""
    return Slices(F.pmod(F.xxhash64(*keys), F.lit(buckets)), by_key=True)


def months(column: str) -> Slices:
    return Slices(F.date_format(F.col(column), "yyyy-MM"), column=column, pattern="%Y-%m")


def days(column: str) -> Slices:
    return Slices(F.date_format(F.col(column), "yyyy-MM-dd"), column=column, pattern="%Y-%m-%d")


class Draft:
    """A new version of a table that is written but not in force."""

    def __init__(self, table: "VersionedTable", version: int, rows: list[tuple], schema: T.StructType):
        self.table, self.version, self.schema = table, version, schema
        self._prepared = False
        self._tuples = rows or [(version, "none", "none", 0, None, None)]
        self.rows = [Row(*_MANIFEST.fieldNames())(*r) for r in self._tuples]

    def read(self) -> DataFrame:
        """What readers would see."""
        return self.table._load(self.rows, self.schema)

    def row_count(self) -> int:
        return sum(r.rows for r in self.rows if _is_data(r))

    def newest(self) -> datetime | None:
        return max((r.mark for r in self.rows if r.mark is not None), default=None)

    def prepare(self) -> None:
        """Write the manifest: one file, so the version is there as a whole or not at all."""
        if self._prepared:
            return
        columns = json.dumps(self.schema.jsonValue())
        (
            self.table.spark.createDataFrame([(*r[:-1], columns) for r in self._tuples], _MANIFEST)
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.table.path}/manifest")
        )
        self._prepared = True

    def adopt(self) -> None:
        self.table._current, self.table.schema = self.rows, self.schema
        self.table._last = max(self.table._last, self.version)

    def commit(self, note: str = "") -> int:
        """Put this version in force."""
        self.prepare()
        if self.table.commits is not None:
            self.table.commits.publish({self.table.name: self.version}, note)
        self.adopt()
        return self.version


class VersionedTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        slices: Slices | None = None,
        mark: str = "updated_at",
        commits: Commits | None = None,
        name: str | None = None,
        keys: Sequence[str] = (),
        directory: int = 64,
        derived: Mapping[str, Column] | None = None,
    ):
        """
        commits, name  the record that says which version is in force, and the table's
                       name there; without it the newest version is
        keys           columns whose places a directory remembers, for upserts by
                       them into slices that do not follow from the key; it has
                       ``directory`` buckets
        derived        columns whose value always follows from others of the row, such as a
                       hash: worked out anew where a row is written rather than moved there
        """
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = self._declared = schema
        self.mark = mark
        self.commits, self.name = commits, name or self.path
        self._current: list[Row] | None = None
        self._last = 0
        self._sliced = slices is not None
        slices = slices or Slices(F.lit("all"))
        self._by_key, self._dated = slices.by_key, (slices.column, slices.pattern)
        self._slice = F.coalesce(slices.value.cast("string"), F.lit("none")).alias(_SLICE)
        self.keys = tuple(keys) if self._sliced and not self._by_key else ()
        self._buckets = directory
        self._derived = dict(derived or {})

    # -- reading ----------------------------------------------------------

    def _manifest(self) -> list[Row]:
        """Rows of the current version: one per folder, so a bounded list.

        Read once per object, which so keeps a consistent view of the table and
        of its own changes; open a new object to see another writer's.
        """
        if self._current is None:
            self._current = self._in_force()
            # The stored columns count: an upsert may have brought new ones.
            if self._current and self._current[0].schema:
                self.schema = T.StructType.fromJson(json.loads(self._current[0].schema))
        return self._current

    def _log(self) -> DataFrame | None:
        folder = f"{self.path}/manifest"
        if not exists(self.spark, folder):  # no version was ever written
            return None
        return self.spark.read.schema(_MANIFEST).parquet(folder)

    def _in_force(self) -> list[Row]:
        log = self._log()
        if log is None:
            return []
        # Versions that were written and not committed keep their numbers.
        self._last = log.agg(F.max("version")).first()[0]
        version = self._last if self.commits is None else self.commits.current().get(self.name)
        return [] if version is None else log.where(F.col("version") == version).collect()

    @property
    def version(self) -> int:
        rows = self._manifest()
        return rows[0].version if rows else 0

    def _next(self) -> int:
        return max(self.version, self._last) + 1

    def exists(self) -> bool:
        return bool(self._manifest())

    def newest(self) -> datetime | None:
        """Largest change time in the table, from the manifest: no scan."""
        return max((r.mark for r in self._manifest() if r.mark is not None), default=None)

    def high_mark(self) -> Column:
        """The same as a literal, the start of time for an empty table."""
        newest = self.newest()
        return F.lit(EPOCH_MARK if newest is None else newest).cast("timestamp_ntz")

    def row_count(self) -> int:
        return sum(r.rows for r in self._manifest() if _is_data(r))

    def _load(self, rows: list[Row], schema: T.StructType | None = None) -> DataFrame:
        schema = schema or self.schema
        folders = [f"{self.path}/{r.folder}" for r in rows if r.rows and _is_data(r)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def read(self) -> DataFrame:
        return self._load(self._manifest())

    def at(self, version: int) -> DataFrame:
        """An older version, as long as it is not vacuumed."""
        if version == self.version:
            return self.read()
        rows = self._log().where(F.col("version") == version).collect()
        if not rows:
            raise ValueError(f"{self.path} has no version {version}")
        return self._load(rows, T.StructType.fromJson(json.loads(rows[0].schema)))

    def slices_since(self, version: int) -> set[str]:
        """Slices whose files are not those of an older version: changed, new or gone."""
        log = self._log()
        old = [] if log is None else log.where(F.col("version") == version).collect()
        held = lambda rows: {(r.slice, r.folder) for r in rows if r.rows and _is_data(r)}
        return {s for s, _ in held(old) ^ held(self._manifest())}

    def only(self, slices: set[str], version: int | None = None) -> DataFrame:
        """Rows of the named slices, now or in an older version; opens only their folders."""
        rows = self._manifest()
        if version is not None and version != self.version:
            rows = self._log().where(F.col("version") == version).collect()
        return self._load([r for r in rows if r.slice in slices])

    def between(self, first: date, last: date) -> DataFrame:
        """Rows of a span of days; opens only the folders of the slices in it."""
        column, pattern = self._dated
        if not column:
            raise ValueError(f"{self.path} is not cut by date")
        low, high = first.strftime(pattern), last.strftime(pattern)
        inside = [r for r in self._manifest() if low <= r.slice <= high]
        day = F.col(column).cast("date")
        return self._load(inside).where(day.between(F.lit(first), F.lit(last)))

    def added(self, version: int) -> DataFrame:
        """Rows written by one version (all of them for a full publish)."""
        rows = [r for r in self._manifest() if r.folder.startswith(f"data/v{version}/")]
        return self._load(rows)

    # -- writing ----------------------------------------------------------

    def _write(
        self, df: DataFrame, version: int, schema: T.StructType | None = None, kept: DataFrame | Sequence[DataFrame] | None = None,
        gathered: bool = False,
    ) -> list[tuple]:
        """Write rows into the folders of a version, one folder per slice. ``kept``: more
        rows, which are read slice by slice and so need no gathering; several frames are
        written one after the other. ``gathered``: nor do the rows."""
        schema = schema or self.schema
        folder = f"data/v{version}"
        columns = [*[F.col(f.name).cast(f.dataType) for f in schema], self._slice]
        derived = {n: c for n, c in self._derived.items() if self._sliced and n in schema.fieldNames()}
        tagged = df.select(*columns).drop(*derived)
        if gathered:
            tagged = df.select(*columns)
        elif self._sliced:
            # Brings a slice's rows together, so tasks do not each write a small
            # file per slice; a large slice is split over several tasks.
            tagged = tagged.hint("rebalance", F.col(_SLICE)).withColumns(derived)
        in_place = gathered or kept is not None
        if isinstance(kept, DataFrame):
            tagged, kept = kept.select(*columns).unionByName(tagged), None
        with open_writers(self.spark) if in_place else nullcontext():
            for n, part in enumerate([*[k.select(*columns) for k in kept or []], tagged]):
                (
                    part.write.mode("append" if n else "overwrite")
                    .option("compression", _CODEC)
                    .partitionBy(_SLICE)
                    .parquet(f"{self.path}/{folder}")
                )
        # Reads the mark column only, of the files just written.
        stats = (
            self.spark.read.schema(
                T.StructType(list(schema) + [T.StructField(_SLICE, T.StringType())])
            )
            .parquet(f"{self.path}/{folder}")
            .groupBy(_SLICE)
            .agg(F.count("*").alias("n"), F.max(self._mark_column(schema)).alias("m"))
        )
        return [
            (version, r[_SLICE], f"{folder}/{_SLICE}={r[_SLICE]}", r.n, r.m, None)
            for r in stats.collect()
        ]

    def _mark_column(self, schema: T.StructType) -> Column:
        if self.mark in schema.fieldNames():
            return F.col(self.mark).cast("timestamp_ntz")
        return F.lit(None).cast("timestamp_ntz")

    # -- the key directory ---------------------------------------------------

    def _entries(self, df: DataFrame) -> DataFrame:
        """(key_hash, slice, bucket_) of rows; a null key can match nothing."""
        found = df.dropna(subset=list(self.keys)).select(
            F.xxhash64(*self.keys).alias(HASH), self._slice.alias("slice")
        )
        return found.select(HASH, "slice", F.pmod(HASH, F.lit(self._buckets)).alias(_BUCKET))

    def _directory(self, rows: list[Row], buckets: set[int]) -> DataFrame:
        """Stored entries of some buckets, which are opened alone."""
        named = {f"{_KEYS}{b}" for b in buckets}
        folders = [f"{self.path}/{r.folder}" for r in rows if r.slice in named]
        if not folders:
            return self.spark.createDataFrame([], _DIRECTORY)
        return self.spark.read.schema(_DIRECTORY).parquet(*folders)

    def _shared(self, old: list[Row], entries: DataFrame) -> tuple[DataFrame, set[int]]:
        """Stored entries whose hash is one of a change's, and the buckets of the change. The
        buckets are met some at a time, so that their hashes can be copied to every task."""
        sizes = {r[_BUCKET]: r["count"] for r in entries.groupBy(_BUCKET).count().collect()}
        pairs = []
        for some, _ in _groups(sizes) or [(set(), 1)]:
            mine = entries if len(some) == len(sizes) else entries.where(F.col(_BUCKET).isin(sorted(some)))
            few = copied_if_small(mine.select(HASH).distinct()) if len(some) < len(sizes) else None
            pairs.append((self._directory(old, some), mine if few is None else few))
        return shared_hashes(*pairs), set(sizes)

    def _write_entries(self, entries: DataFrame, version: int) -> list[tuple]:
        folder = f"keys/v{version}"
        path = f"{self.path}/{folder}"
        # One exchange, by bucket, does for the distinct entries and for one file a bucket.
        gathered = entries.repartition(_BUCKET).distinct()
        gathered.write.mode("overwrite").option("compression", _CODEC).partitionBy(_BUCKET).parquet(path)
        schema = T.StructType([*_DIRECTORY, T.StructField(_BUCKET, T.LongType())])
        counts = self.spark.read.schema(schema).parquet(path).groupBy(_BUCKET).count()
        return [
            (version, f"{_KEYS}{r[_BUCKET]}", f"{folder}/{_BUCKET}={r[_BUCKET]}", r["count"], None, None)
            for r in counts.collect()
        ]

    def _indexed(self, written: list[tuple], version: int, schema: T.StructType | None = None) -> list[tuple]:
        """A whole new directory for files just written."""
        if not self.keys:
            return []
        new = [Row(*_MANIFEST.fieldNames())(*r) for r in written]
        return self._write_entries(self._entries(self._load(new, schema)), version)

    def _extended(
        self, old: list[Row], delta: DataFrame, buckets: set[int], version: int, known: DataFrame | None = None
    ) -> list[tuple]:
        """The directory's manifest entries once a delta's places are added. A place that
        is ``known`` is not added again; a bucket of many small files becomes one."""
        known = self._directory(old, buckets) if known is None else copied_if_small(known) or known
        fresh = self._entries(delta).join(known, [HASH, "slice"], "left_anti")
        files = Counter(r.slice for r in old)
        full = {b for b in buckets if files[f"{_KEYS}{b}"] >= _COMPACT}
        if full:
            bucket = F.pmod(HASH, F.lit(self._buckets)).alias(_BUCKET)
            fresh = fresh.unionByName(self._directory(old, full).select(HASH, "slice", bucket))
        left_out = {f"{_KEYS}{b}" for b in full}
        carried = [r for r in old if r.slice.startswith(_KEYS) and r.slice not in left_out]
        return _carry(carried, version) + self._write_entries(fresh, version)

    # -- drafts: a change before it is in force ---------------------------------

    def draft(self, df: DataFrame, gathered: bool = False) -> Draft:
        """All content anew, in the declared columns. ``gathered``: each task's rows are of
        few slices, so that they are written where they are."""
        version, schema = self._next(), self._declared
        written = self._write(df, version, schema, gathered=gathered)
        return Draft(self, version, written + self._indexed(written, version, schema), schema)

    def draft_empty(self) -> Draft:
        return Draft(self, self._next(), [], self.schema)

    def draft_slices(self, df: DataFrame, slices: set[str]) -> Draft:
        """Some slices anew: ``df`` has all rows they will hold, and no others."""
        if self.keys:
            raise ValueError(f"{self.path}: slices of a table with a key directory change by key")
        version = self._next()
        carried = [r for r in self._manifest() if r.slice not in slices]
        return Draft(self, version, _carry(carried, version) + self._write(df, version), self.schema)

    def draft_upsert(
        self, delta: DataFrame, keys: Sequence[str], guard: str | None = None, evolve: bool = False,
        gathered: DataFrame | None = None,
    ) -> Draft:
        """See ``upsert``."""
        old = self._manifest()  # also sets the stored columns
        version, schema = self._next(), self.schema
        stored = self._load(old)
        if evolve and delta.schema.simpleString() != schema.simpleString():
            stored, delta = reconcile(stored, delta)
            schema = delta.schema
            touched, buckets = None, None
        else:
            delta = reconcile(delta, stored)[0]
            if self._has_directory(keys, old):
                return self._upsert_by_directory(old, delta, guard, version, gathered)
            touched, buckets = self._touched(delta, keys, old)
            stored = self._load([r for r in old if touched is None or r.slice in touched])
        # The stored keys are read only if the delta repeats a key at all.
        repeated = old and not duplicate_keys(key_hashes(delta, keys), [HASH]).isEmpty()
        if repeated and not merge_conflicts(stored, delta, keys).isEmpty():
            raise MergeConflict(f"{self.path}: a stored row has several new rows")
        merged = apply_upsert(stored, delta, keys, guard) if old else delta
        return self._drafted(old, merged, delta, touched, buckets, version, schema)

    def _has_directory(self, keys: Sequence[str], old: list[Row]) -> bool:
        return bool(self.keys) and tuple(keys) == self.keys and any(r.slice.startswith(_KEYS) for r in old)

    def _upsert_by_directory(
        self, old: list[Row], delta: DataFrame, guard: str | None, version: int, gathered: DataFrame | None = None
    ) -> Draft:
        """The directory tells the hashes of keys that are stored already and their slices.
        Those slices and the ones their rows go to are rewritten; other slices get a folder
        with their new rows."""
        keys, schema = self.keys, self.schema
        entries = self._entries(delta)
        shared, buckets = self._shared(old, entries)
        few = copied_if_small(shared.select(HASH).distinct())
        coming = entries.join(shared.select(HASH) if few is None else few, HASH, "left_semi")
        places = shared.select("slice").union(coming.select("slice")).distinct()
        rewritten = {r[0] for r in places.collect()}  # as many as there are slices
        folders = Counter(r.slice for r in old if _is_data(r) and r.rows)
        full = {s for s, n in folders.items() if n >= _COMPACT}
        if full:
            rewritten |= full & {r[0] for r in delta.select(self._slice).distinct().collect()}
        inside = [r for r in old if r.slice in rewritten]
        stored = self._load(inside)
        met, meeting = (stored, delta) if few is None else (apart(df, keys, few)[0] for df in (stored, delta))
        repeated = not duplicate_keys(key_hashes(meeting, keys), [HASH]).isEmpty()
        if repeated and not merge_conflicts(met, meeting, keys).isEmpty():
            raise MergeConflict(f"{self.path}: a stored row has several new rows")
        apart_ = gathered is not None and few is not None
        source = meeting if apart_ else delta
        kept, content = upsert_parts(stored, source, keys, shared, guard) or (None, apply_upsert(stored, delta, keys, guard))
        if kept is not None and apart_:  # new rows are where they belong
            kept = kept.unionByName(apart(gathered, keys, few)[1].select(*kept.columns))
        if kept is not None and self._crowded(inside, stored):
            kept, content = None, kept.unionByName(content)
        carried = [r for r in old if r.slice not in rewritten and not r.slice.startswith(_KEYS)]
        written = self._write(content, version, schema, kept)
        return Draft(self, version, _carry(carried, version) + written + self._extended(old, delta, buckets, version, shared), schema)

    def _crowded(self, rows: list[Row], stored: DataFrame) -> bool:
        """Whether slices hold many small files."""
        files = len(stored.inputFiles())
        return files > _COMPACT * len({r.slice for r in rows}) and sum(r.rows for r in rows) < _FULL_FILE * files

    def draft_replace(self, rows: DataFrame, keys: Sequence[str], gathered: DataFrame | None = None) -> Draft:
        """The stored rows of all keys that ``rows`` holds go, and ``rows`` come: a key may
        have several rows before and after. Give landed rows, they are read again.
        ``gathered``: the same rows, each task's of few slices."""
        old = self._manifest()
        version = self._next()
        rows = reconcile(rows, self._load(old))[0]
        if self._has_directory(keys, old):
            return self._replace_by_directory(old, rows, version, gathered)
        touched, buckets = self._touched(rows, keys, old)
        stored = self._load([r for r in old if touched is None or r.slice in touched])
        kept = stored.join(rows.select(*keys).distinct(), list(keys), "left_anti").select(*rows.columns)
        return self._drafted(old, kept.unionByName(rows), rows, touched, buckets, version, self.schema)

    def _replace_by_directory(self, old: list[Row], rows: DataFrame, version: int, gathered: DataFrame | None) -> Draft:
        """The directory tells the hashes of keys that go and their slices. Those slices and
        the ones that rows go to are rewritten, some at a time, so that the hashes that go
        from them can be copied to every task and their other rows stay where they are."""
        keys, schema = list(self.keys), self.schema
        entries = self._entries(rows)
        shared, buckets = self._shared(old, entries)
        going = {r.slice: r["count"] for r in shared.groupBy("slice").count().collect()}
        coming = {r[0] for r in rows.select(self._slice).distinct().collect()}
        kept, met, seen = [], [], scratch_dir(self.spark, "met-keys")
        for some, shares in _groups(dict.fromkeys(coming, 0) | going):
            stored = self._load([r for r in old if r.slice in some])
            gone = shared.where(F.col("slice").isin(sorted(some))).select(HASH).distinct()
            for i in range(shares):
                mine, hashes = stored.dropna(subset=keys), gone
                if shares > 1:
                    mine, hashes = (df.where(F.pmod(h, F.lit(shares)) == i) for df, h in ((mine, F.xxhash64(*keys)), (gone, F.col(HASH))))
                few = copied_if_small(hashes)
                here, others = apart(mine, keys, hashes if few is None else few)
                here.select(*keys).write.mode("append").option("compression", _CODEC).parquet(seen)
                kept.append(others if i else others.unionByName(stored.where(_any_null(keys))))
                met.append(here)
        # Rows that only share a hash with a key that goes stay too.
        if met:
            spared = self.spark.read.schema(met[0].select(*keys).schema).parquet(seen)
            spared = spared.join(rows.select(*keys).distinct(), keys, "left_anti")
            on = {k: k for k in keys}
            kept += [] if spared.isEmpty() else [lookup_join(m, spared, on, "left_semi", measure=True) for m in met]
        inside = [r for r in old if r.slice in going.keys() | coming]
        content, in_place = (rows, False) if gathered is None else (gathered, True)
        if kept and self._crowded(inside, self._load(inside)):
            content, in_place, kept = reduce(DataFrame.unionByName, kept, rows), False, None
        carried = [r for r in old if _is_data(r) and r.slice not in going.keys() | coming]
        beside = [r for r in old if r.slice == _BESIDE]
        written = self._write(content, version, schema, kept, in_place)
        index = self._extended(old, rows, buckets, version, shared)
        return Draft(self, version, _carry(carried + beside, version) + written + index, schema)

    def _drafted(
        self, old: list[Row], content: DataFrame, delta: DataFrame, touched: set[str] | None,
        buckets: set[int] | None, version: int, schema: T.StructType,
    ) -> Draft:
        """``content`` in place of the touched slices, or of all."""
        carried = [r for r in old if touched is not None and _is_data(r) and r.slice not in touched]
        beside = [r for r in old if r.slice == _BESIDE]
        written = self._write(content, version, schema)
        if buckets is None:
            index = self._indexed(written, version, schema) if touched is None else [
                r for r in _carry(old, version) if r[1].startswith(_KEYS)
            ]
        else:
            index = self._extended(old, delta, buckets, version)
        return Draft(self, version, _carry(carried + beside, version) + written + index, schema)

    def _touched(
        self, delta: DataFrame, keys: Sequence[str], old: list[Row]
    ) -> tuple[set[str] | None, set[int] | None]:
        """Slices that hold a key of the delta or will receive one of its rows, all if
        None; and the buckets of the directory that told it, None without one."""
        slices = {r.slice for r in old if _is_data(r)}
        found = delta.select(self._slice).distinct()
        buckets = None
        if self._has_directory(keys, old):
            entries = self._entries(delta)
            buckets = {r[0] for r in entries.select(_BUCKET).distinct().collect()}
            holding = self._directory(old, buckets).join(entries.select(HASH), HASH, "left_semi")
            found = found.union(holding.select("slice").distinct()).distinct()
        elif self.keys or len(slices) <= 1:
            return None, None
        elif not self._by_key:
            holding = self._load(old).select(*keys, self._slice).join(
                delta.select(*keys).distinct(), list(keys), "left_semi"
            )
            found = found.union(holding.select(_SLICE).distinct()).distinct()
        return {r[0] for r in found.collect()}, buckets  # as many as the table has slices

    # -- changes that are in force at once ----------------------------------------

    def publish(self, df: DataFrame, gathered: bool = False) -> int:
        """Replace the content, and the columns by the declared ones. See ``draft``."""
        return self.draft(df, gathered).commit()

    def truncate(self) -> int:
        """Replace the content by nothing."""
        return self.draft_empty().commit()

    def upsert(
        self,
        delta: DataFrame,
        keys: Sequence[str],
        guard: str | None = None,
        evolve: bool = False,
        gathered: DataFrame | None = None,
    ) -> int:
        """Merge rows by key, rewriting only the slices they touch.

        ``delta`` is read several times: pass landed rows, not a costly plan.
        With ``evolve`` the table takes over the delta's columns, which rewrites
        it whole; otherwise the delta is matched to the table's columns. ``gathered``:
        the same rows in the table's columns, each task's of few slices.
        """
        return self.draft_upsert(delta, keys, guard, evolve, gathered).commit()

    def append(
        self,
        df: DataFrame,
        beside: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """Add rows without looking at the stored ones.

        ``beside`` makes a few more rows of the written ones, such as one per
        file. They are kept next to the table and appear with the same commit.
        """
        old, version = self._manifest(), self._next()
        written = self._write(df, version)
        more = self._indexed(written, version)
        if beside:
            folder = f"beside/v{version}"
            new = [Row(*_MANIFEST.fieldNames())(*r) for r in written]
            n = append_rows(beside(self._load(new)).coalesce(1), f"{self.path}/{folder}")
            more.append((version, _BESIDE, folder, n, None, None))
        return Draft(self, version, _carry(old, version) + written + more, self.schema).commit()

    def beside(self, schema: T.StructType) -> DataFrame:
        """What the commits of the current rows brought beside them."""
        folders = [
            f"{self.path}/{r.folder}" for r in self._manifest() if r.slice == _BESIDE
        ]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def vacuum(self, keep: Sequence[int] = ()) -> int:
        """Delete the folders that the version in force does not name; their number.

        Readers of older versions lose them, so wait until those are done, or name
        the versions to keep.
        """
        named = {r.folder for r in self._manifest()}
        if keep:
            named |= {r.folder for r in self._log().where(F.col("version").isin(list(keep))).collect()}
        return sum(
            remove_others(self.spark, f"{self.path}/{top}", f"{top}/", named)
            for top in ("data", "beside", "keys")
        )


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def _groups(sizes: Mapping[Hashable, int]) -> list[tuple[set, int]]:
    """Names in groups of which no more hashes come than can be copied, and into how many
    shares the hashes of a name that has more are to be cut."""
    most = max(1, joins.COPIED // _HASH_BYTES)
    groups, size = [], 0
    for name in sorted(sizes):
        n = sizes[name]
        if not groups or size + n > most:
            groups.append((set(), 1 if n <= most else 1 + n * 5 // (most * 4)))
            size = 0
        groups[-1][0].add(name)
        size += n
    return groups


def _carry(rows: list[Row], version: int) -> list[tuple]:
    return [(version, r.slice, r.folder, r.rows, r.mark, None) for r in rows if r.rows]
