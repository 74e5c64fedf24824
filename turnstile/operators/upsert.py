"""Keyed upsert as a join of the stored rows and the new rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .aggregates import duplicate_keys
from .joins import SALTS, copied_if_small

#: Column of a key's hash.
HASH = "key_hash"


class MergeConflict(Exception):
    """Several new rows claim the same stored row."""


def merge_conflicts(
    target: DataFrame, source: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Keys that occur once or more in the target and repeatedly in the source."""
    repeated = duplicate_keys(source, keys, skip_nulls=True).select(*keys)
    return repeated.join(target.select(*keys), list(keys), "left_semi")


def _side(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Columns under a prefix, a presence flag, and a salt for null keys.

    A null key never matches; unsalted, all such rows would meet in one task.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
    return df.select(
        *[F.col(c).alias(prefix + c) for c in df.columns],
        F.lit(True).alias(prefix + "present"),
        F.when(any_null, spread).otherwise(F.lit(0)).alias(prefix + "salt"),
    )


def merge_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored and new rows met by key: columns under ``t_`` and ``s_``, and a flag
    ``present`` of either side. A row with a null key meets none."""
    t, s = _side(target, "t_", keys), _side(source, "s_", keys)
    on = [F.col("t_" + k) == F.col("s_" + k) for k in keys]
    on.append(F.col("t_salt") == F.col("s_salt"))
    return t.join(s, on, "full_outer")


def merge_state() -> Column:
    """What a merge does with a row of ``merge_match``: insert, keep or match."""
    return (
        F.when(F.col("t_present").isNull(), "insert")
        .when(F.col("s_present").isNull(), "keep")
        .otherwise("match")
    )


def key_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key_hash) of rows; a null key can match nothing."""
    return df.dropna(subset=list(keys)).select(F.xxhash64(*keys).alias(HASH))


def shared_hashes(*pairs: tuple[DataFrame, DataFrame]) -> DataFrame:
    """The rows of each target whose ``key_hash`` is one of its source's, written once: as many
    bytes are shuffled as hashes have, not rows."""
    target = pairs[0][0]
    folder = scratch_dir(target.sparkSession, "shared-hashes")
    for stored, source in pairs:
        stored.join(source.select(HASH), HASH, "left_semi").write.mode("append").parquet(folder)
    return target.sparkSession.read.schema(target.schema).parquet(folder)


def apart(df: DataFrame, keys: Sequence[str], hashes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key has one of the hashes, and the others."""
    hashed = df.withColumn(HASH, F.xxhash64(*keys))
    return tuple(hashed.join(hashes, HASH, how).select(*df.columns) for how in ("left_semi", "left_anti"))


def upsert_parts(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    shared: DataFrame,
    guard: str | None = None,
    update: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame] | None:
    """``apply_upsert`` as stored rows that stay and rows that are new or were met, of which
    only those whose key's hash is in ``shared`` are moved to meet by key.

    None if the hashes are too many to be copied to every task, or the sides' keys
    differ in type, so that equal ones need not hash alike. Both sides are read twice.
    """
    if any(target.schema[k].dataType != source.schema[k].dataType for k in keys):
        return None
    few = copied_if_small(shared.select(HASH).distinct())
    if few is None:
        return None
    met, kept = apart(target, keys, few)
    meeting, new = apart(source.select(*target.columns), keys, few)
    return kept, apply_upsert(met, meeting, keys, guard, update).unionByName(new)


def upsert_by_hash(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    guard: str | None = None,
    update: Sequence[str] | None = None,
) -> DataFrame:
    """``apply_upsert`` of stored rows and landed rows, which are read several times:
    the hashes of their keys meet first, then only the rows that share one."""
    shared = shared_hashes((key_hashes(target, keys), key_hashes(source, keys)))
    parts = upsert_parts(target, source, keys, shared, guard, update)
    return parts[0].unionByName(parts[1]) if parts else apply_upsert(target, source, keys, guard, update)


def apply_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    guard: str | None = None,
    update: Sequence[str] | None = None,
) -> DataFrame:
    """Stored rows after the new rows are merged in.

    Matched rows take the source's values for ``update`` (default: all columns
    but the keys), with a ``guard`` only where the source's value of that
    column is greater; a null on either side of the guard keeps the stored row.
    Unmatched source rows are added, unmatched stored rows stay. Both sides
    must have the same columns (see ``reconcile``).
    """
    columns = target.columns
    changing = [c for c in columns if c not in keys] if update is None else update
    joined = merge_match(target, source.select(*columns), keys)

    new = F.col("t_present").isNull()
    replaced = F.col("s_present").isNotNull()
    if guard:
        newer = F.col("s_" + guard) > F.col("t_" + guard)
        replaced = replaced & F.coalesce(newer, F.lit(False))

    def pick(c: str) -> Column:
        take = (new | replaced) if c in changing else new
        return F.when(take, F.col("s_" + c)).otherwise(F.col("t_" + c)).alias(c)

    return joined.select(*[pick(c) for c in columns])
