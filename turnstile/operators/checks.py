"""Declarative data-quality checks.

All row conditions of a table are counted in one aggregate over one scan.
Uniqueness and relationships need a grouping; there the column is counted per
value first, so hot values travel as one row.
"""

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join
from .orphans import unrelated_pairs


@dataclass(frozen=True)
class Check:
    """One check; build it with the functions below."""

    name: str
    table: str
    kind: str
    condition: str = ""
    columns: tuple[str, ...] = ()
    parent: str = ""
    parent_columns: tuple[str, ...] = ()
    nulls: bool = False
    via: str = ""
    key: str = ""


def bad_rows(name: str, table: str, condition: str) -> Check:
    """Rows for which a SQL condition holds are bad."""
    return Check(name, table, "rows", condition)


def not_null(table: str, column: str) -> Check:
    return bad_rows(f"not_null({column})", table, f"{column} IS NULL")


def accepted(
    table: str, column: str, values: Sequence[str], null_passes: bool = True
) -> Check:
    listed = ", ".join(f"'{v}'" for v in values)
    bad = f"{column} NOT IN ({listed})"
    if not null_passes:
        bad = f"{column} IS NULL OR {bad}"
    return bad_rows(f"accepted_values({column})", table, bad)


def nonempty(table: str) -> Check:
    return Check("nonempty", table, "nonempty")


def unique(table: str, column: str, nulls: bool = False) -> Check:
    """No value twice; with ``nulls`` a repeated null counts as well."""
    return Check(f"unique({column})", table, "unique", columns=(column,), nulls=nulls)


def related(
    table: str,
    columns: str | tuple[str, ...],
    parent: str,
    parent_columns: str | tuple[str, ...],
    nulls: bool = False,
) -> Check:
    """Every key has a parent; null keys pass unless ``nulls`` is set."""
    c = (columns,) if isinstance(columns, str) else columns
    p = (parent_columns,) if isinstance(parent_columns, str) else parent_columns
    name = f"relationships({', '.join(c)} -> {parent})"
    return Check(name, table, "related", "", c, parent, p, nulls)


def related_through(
    table: str, key: str, via: str, owner: str, other: str, parent: str
) -> Check:
    """Every row's pair of the ``owner`` that its ``key`` has in ``via`` and its own
    ``other`` is in the parent; a null ``other`` is not."""
    name = f"relationships({via}.{owner}, {other} -> {parent})"
    return Check(name, table, "through", "", (owner, other), parent, (owner, other), True, via, key)


def _line(check: Check, failed: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        failed.cast("bigint").alias("failed_count"),
    )


def _one_pass(df: DataFrame, checks: list[Check]) -> DataFrame:
    def count(c: Check) -> Column:
        if c.kind == "nonempty":
            return F.when(F.count("*") == 0, 1).otherwise(0)
        return F.count_if(F.expr(c.condition))

    return df.agg(
        F.array(*[_line(c, count(c)) for c in checks]).alias("lines")
    ).select(F.inline("lines"))


def _unique(df: DataFrame, check: Check) -> DataFrame:
    keys = list(check.columns)
    if not check.nulls:
        df = df.dropna(subset=keys)
    per_value = df.groupBy(*keys).agg(F.count("*").alias("n"))
    failed = per_value.agg(F.count_if(F.col("n") > 1).alias("failed"))
    return failed.select(_line(check, F.col("failed")).alias("l")).select("l.*")


def _related(df: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    keys = list(check.columns)
    if not check.nulls:
        df = df.dropna(subset=keys)
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    on = dict(zip(keys, check.parent_columns))
    lost = lookup_join(per_key, parent, on, "left_anti")
    failed = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed"))
    return failed.select(_line(check, F.col("failed")).alias("l")).select("l.*")


def _through(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    owner, other = check.columns
    lost = unrelated_pairs(
        tables[check.table], tables[check.via], check.key, owner, other,
        tables[check.parent], check.parent_columns,
    )
    failed = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed"))
    return failed.select(_line(check, F.col("failed")).alias("l")).select("l.*")


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, table, PASS or FAIL, number of failures."""
    single = defaultdict(list)
    results = []
    for c in checks:
        if c.kind in ("rows", "nonempty"):
            single[c.table].append(c)
        elif c.kind == "unique":
            results.append(_unique(tables[c.table], c))
        elif c.kind == "through":
            results.append(_through(tables, c))
        else:
            results.append(_related(tables[c.table], tables[c.parent], c))
    results += [_one_pass(tables[t], cs) for t, cs in single.items()]
    if not results:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "check_name string, table_name string, status string, failed_count bigint")
    log = reduce(DataFrame.unionByName, results)
    status = F.when(F.col("failed_count") == 0, "PASS").otherwise("FAIL")
    return log.select("check_name", "table_name", status.alias("status"), "failed_count")


class ChecksFailed(Exception):
    """A check with severity ``error`` found bad data."""


def assert_checks(log: DataFrame, severity: str = "error") -> list:
    """Failed checks; raises on any of them unless the severity is ``warn``."""
    failed = log.where(F.col("status") == "FAIL").collect()  # a row per check
    if failed and severity == "error":
        named = ", ".join(f"{r.table_name}.{r.check_name}={r.failed_count}" for r in failed)
        raise ChecksFailed(named)
    return failed
