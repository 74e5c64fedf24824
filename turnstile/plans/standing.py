"""Uniqueness and relationship checks that look at what has changed only.

For each check the number of rows per key is stored, in buckets by key. A change of
a table is the difference between two of its versions over the slices that differ; it
is added to the counts of its own keys, and by what that does to them the number of
failures rises or falls. Whole columns are grouped once, at the start.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import Check
from ..schemas import fields
from ..sources.commits import Commits, commit_together
from ..sources.files import land
from ..sources.tables import VersionedTable, key_buckets

_COUNTS = fields("check_id string, key string, child bigint, parent bigint")
_KEYS = ["check_id", "key"]


def _id(check: Check) -> str:
    return f"{check.table}.{check.name}"


def _key(columns: Sequence[str], nulls: bool) -> Column:
    """A key as text; null where a part is null and nulls do not count."""
    whole = F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})
    if nulls:
        return whole
    known = reduce(Column.__and__, (F.col(c).isNotNull() for c in columns))
    return F.when(known, whole)


class StandingChecks:
    """Checks of the kinds ``unique`` and ``related`` over versioned tables."""

    def __init__(self, spark: SparkSession, path: str, checks: Sequence[Check], buckets: int = 64):
        odd = [c.name for c in checks if c.kind not in ("unique", "related")]
        if odd:
            raise ValueError(f"checks of rows need no counts: {odd}")
        self.spark, self.path, self.checks = spark, path.rstrip("/"), list(checks)
        self.commits = Commits(spark, f"{self.path}/commits")
        self.counts = VersionedTable(
            spark, f"{self.path}/counts", _COUNTS, key_buckets(_KEYS, buckets), commits=self.commits, name="counts"
        )

    def _changed(self, table: VersionedTable, name: str, columns: Sequence[str], nulls: bool) -> DataFrame:
        """(key, n): rows a key has gained or lost since the counts were made."""
        key = _key(columns, nulls).alias("key")
        since = self.commits.current().get(f"basis/{name}")
        if since is None:
            rows = table.read().select(key, F.lit(1).alias("n"))
        else:
            slices = table.slices_since(since)
            new = table.only(slices).select(key, F.lit(1).alias("n"))
            rows = new.unionByName(table.only(slices, since).select(key, F.lit(-1).alias("n")))
        return rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.sum("n").alias("n")).where("n <> 0")

    def _deltas(self, tables: Mapping[str, VersionedTable]) -> DataFrame:
        zero, found = F.lit(0).cast("bigint"), []
        for c in self.checks:
            child = self._changed(tables[c.table], c.table, c.columns, c.nulls)
            found.append(child.select(F.lit(_id(c)).alias("check_id"), "key", F.col("n").alias("child"), zero.alias("parent")))
            if c.kind == "related":
                parent = self._changed(tables[c.parent], c.parent, c.parent_columns, False)
                found.append(parent.select(F.lit(_id(c)).alias("check_id"), "key", zero.alias("child"), F.col("n").alias("parent")))
        return reduce(DataFrame.unionByName, found).groupBy(*_KEYS).agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))

    def refresh(self, tables: Mapping[str, VersionedTable]) -> DataFrame:
        """The checks' results for the versions in force, as ``run_checks`` gives them."""
        current = self.commits.current()
        versions = {f"basis/{n}": tables[n].version for c in self.checks for n in (c.table, c.parent) if n}
        totals = {f"failed/{_id(c)}": current.get(f"failed/{_id(c)}", 0) for c in self.checks}
        if any(current.get(n) != v for n, v in versions.items()):
            folder = f"{self.path}/delta/{self.counts.version + 1}"
            land(self._deltas(tables), folder, "child")
            delta = self.spark.read.parquet(folder)
            slices = {r[0] for r in delta.select(self.counts._slice).distinct().collect()}  # buckets
            before = self.counts.only(slices).select(*_KEYS, F.col("child").alias("c0"), F.col("parent").alias("p0"))
            merged = delta.join(before, _KEYS, "left").na.fill(0, ["c0", "p0"])
            after = merged.select(*_KEYS, (F.col("child") + F.col("c0")).alias("child"), (F.col("parent") + F.col("p0")).alias("parent"), "c0", "p0")
            unique = [_id(c) for c in self.checks if c.kind == "unique"]
            bad = lambda n, p: F.when(F.col("check_id").isin(unique), (F.col(n) > 1).cast("bigint")).otherwise(F.when(F.col(p) == 0, F.col(n)).otherwise(0))
            moved = after.groupBy("check_id").agg(F.sum(bad("child", "parent") - bad("c0", "p0")).alias("n"))
            for r in moved.collect():  # a row for each check
                totals[f"failed/{r.check_id}"] += r.n
            draft = self.counts.draft_upsert(after.select(*_KEYS, "child", "parent"), _KEYS)
            commit_together([draft], "checks", {**versions, **totals})
        log = [(c.name, c.table, "FAIL" if totals[f"failed/{_id(c)}"] else "PASS", totals[f"failed/{_id(c)}"]) for c in self.checks]
        return self.spark.createDataFrame(log, "check_name string, table_name string, status string, failed_count bigint")
