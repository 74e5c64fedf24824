"""Children without a parent.

The child side is counted per key before any exchange, so a key holding a third
of the rows travels as one row.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join


def orphan_count(
    child: DataFrame,
    parent: DataFrame,
    on: Mapping[str, str],
    count_nulls: bool = True,
    name: str = "orphans",
) -> DataFrame:
    """How many child rows find no parent; null keys count unless told not to."""
    keys = list(on)
    if not count_nulls:
        child = child.dropna(subset=keys)
    per_key = child.groupBy(*keys).agg(F.count("*").alias("_n"))
    lost = lookup_join(per_key, parent, on, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))


def orphan_rows(
    child: DataFrame,
    parent: DataFrame,
    on: Mapping[str, str],
    spread: Sequence[str] = (),
    hot: Sequence[int] = (),
) -> DataFrame:
    """Child rows whose key is given but unknown."""
    return lookup_join(
        child.dropna(subset=list(on)), parent, on, "left_anti", None, spread, hot
    )


def unrelated_pairs(
    child: DataFrame,
    via: DataFrame,
    key: str,
    owner: str,
    other: str,
    parent: DataFrame,
    parent_on: tuple[str, str] | None = None,
    name: str = "n",
) -> DataFrame:
    """Pairs (``owner``, ``other``) that occur in ``child`` and not in ``parent``,
    with the number of child rows.

    The owner is not the child's own column but that of the row of ``via`` its
    ``key`` points to; a key unknown there is another check's affair. A null in a
    pair is in no parent.
    """
    mine, theirs = parent_on or (owner, other)
    per_key = child.groupBy(key, other).agg(F.count("*").alias(name))
    owned = lookup_join(per_key, via.select(key, owner), {key: key}, "inner")
    pairs = owned.groupBy(owner, other).agg(F.sum(name).alias(name))
    return lookup_join(pairs, parent, {owner: mine, other: theirs}, "left_anti")
