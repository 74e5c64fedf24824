"""Joins from a large, possibly skewed side to a reference side.

Three things go wrong when these joins leave the broadcast range: rows with a
null key all hash to one partition, a hot key fills one partition, and the
reference side may be too large to copy to every executor. ``lookup_join``
answers each: nulls are spread by a salt, hot keys are salted with their
reference rows copied per salt, and Spark's own size check decides on a broadcast.
Spark takes a joined table for as large as the product of its parts, so a reference
side may be measured instead. All of it leaves the result exactly that of the plain join.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import OPEN_END
from ..functions.text import join_name

SALTS = 64
#: A measured reference side of up to as many bytes is copied to every executor.
COPIED = 64 * 2**20
#: Parts of a larger one at most, each landed with its own files.
PARTS = 64


def _token(columns: Sequence[Column | str]) -> Column:
    return F.xxhash64(*columns)


def _same_types(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> None:
    """Equal keys must hash alike on both sides, or salted rows would miss."""
    for l, r in on.items():
        a, b = left.schema[l].dataType, right.schema[r].dataType
        if a != b:
            raise TypeError(f"salted join keys differ in type: {l} {a}, {r} {b}")


def hot_tokens(
    df: DataFrame, keys: Sequence[str], share: float = 0.01
) -> list[int]:
    """Hashes of all keys that hold more than ``share`` of the rows.

    One pass with a bounded sketch per task (frequent items: no key above the
    share is missed, a few below it may be named). At most ``1 / share`` values
    come to the driver, whatever the size of ``df``.
    """
    token = df.dropna(subset=list(keys)).select(_token(keys).alias("k"))
    return list(token.stat.freqItems(["k"], share).first()[0])


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's size estimate lets it broadcast ``df`` by itself."""
    session = df.sparkSession._jsparkSession
    limit = session.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``, by counting them: 8 a value and the length of texts."""
    texts = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    row = sum(texts, F.lit(8 * (len(df.columns) + 1)))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def copied_if_small(df: DataFrame) -> DataFrame | None:
    """``df`` marked for a broadcast if it measures at most ``COPIED`` bytes, else None.
    None too where broadcasts are switched off."""
    if df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() < 0:
        return None
    return F.broadcast(df) if measured_bytes(df) <= COPIED else None


def parts_of(right: DataFrame, keys: Sequence[str]) -> int:
    """Parts by ``part_of`` that a reference is to be cut into, so that each may be copied."""
    if right.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() < 0:
        return 1
    size = measured_bytes(right.dropna(subset=list(keys)))
    # A fifth to spare, as parts are not alike; parts of more than ``PARTS`` may be shuffled.
    return 1 if size <= COPIED else min(PARTS, 1 + size * 5 // (COPIED * 4))


def part_of(keys: Sequence[str], parts: int) -> Column:
    """Part of a row by its key: equal keys of one type share a part, so that a join by
    them is the union of the joins of the parts."""
    return F.pmod(_token(keys), F.lit(parts))


def repeats(df: DataFrame) -> DataFrame:
    """Only the rows of ``df`` that occur more than once, as often as they do."""
    twice = df.groupBy(*df.columns).agg(F.count("*").alias("_n")).where("_n > 1")
    return twice.withColumn("_n", F.explode(F.expr("sequence(1L, _n)"))).drop("_n")


def hot_for(
    left: DataFrame, keys: Sequence[str], right: DataFrame, share: float = 0.01
) -> list[int]:
    """Hot keys of ``left`` where they matter: the join to ``right`` will shuffle.

    Give ``left`` as stored rows rather than a costly plan; its keys are read.
    """
    return [] if fits_broadcast(right) else hot_tokens(left, keys, share)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "left",
    within: Column | None = None,
    spread: Sequence[str] = (),
    hot: Sequence[int] = (),
    measure: bool = False,
) -> DataFrame:
    """Join ``left`` to ``right`` on ``{left column: right column}``.

    how      left, inner, left_semi or left_anti
    within   further condition over columns of both sides
    spread   columns of ``left`` whose hash spreads rows with a null or hot key
    hot      tokens from ``hot_tokens`` of the left keys
    measure  read ``right`` once more, to copy it if it is small; a left join to keys
             alone then meets the repeated ones only, no other changes its result

    The right keys are not part of the result; other columns must not clash.
    """
    inner = how in ("inner", "left_semi")
    keep_right = how in ("left", "inner")
    keys = [(l, f"_r_{i}") for i, l in enumerate(on)]
    ref = right.withColumnsRenamed(
        {r: f"_r_{i}" for i, r in enumerate(on.values())}
    )
    if not keep_right and within is None:
        # Only the keys matter; without this copies of a key would be shuffled.
        ref = ref.select(*[r for _, r in keys]).distinct()
    # Rows of the right with a null key can match nothing.
    ref = ref.dropna(subset=[r for _, r in keys])
    if measure and how == "left" and within is None and len(ref.columns) == len(keys):
        ref = repeats(ref)
    small = copied_if_small(ref) if measure else None
    if small is not None:
        ref, spread, hot = small, (), ()

    condition = [F.col(l) == F.col(r) for l, r in keys]
    salted = bool(spread) and (not inner or bool(hot))
    if salted:
        if hot:
            _same_types(left, right, on)
        piece = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
        salt = F.lit(0)
        copies = F.array(F.lit(0))
        if hot:
            is_hot = _token([l for l, _ in keys]).isin(list(hot))
            salt = F.when(is_hot, piece).otherwise(salt)
            copies = F.when(
                _token([r for _, r in keys]).isin(list(hot)),
                F.sequence(F.lit(0), F.lit(SALTS - 1)),
            ).otherwise(copies)
        if not inner:
            any_null = F.lit(False)
            for l, _ in keys:
                any_null = any_null | F.col(l).isNull()
            salt = F.when(any_null, piece).otherwise(salt)
        left = left.withColumn("_salt", salt)
        # Always 0 for other rows, but no constant in the optimizer's eyes: it
        # would fold one into a filter and take the salt out of the exchange.
        zero = F.pmod(_token([r for _, r in keys]), F.lit(1)).cast("int")
        ref = ref.withColumn("_r_salt", F.explode(copies) if hot else zero)
        condition.append(F.col("_salt") == F.col("_r_salt"))
    if within is not None:
        condition.append(within)

    joined = left.join(ref, condition, how)
    drop = ["_salt"] if salted else []
    if keep_right:
        drop += [r for _, r in keys] + (["_r_salt"] if salted else [])
    return joined.drop(*drop)


def name_join(
    left: DataFrame,
    right: DataFrame,
    left_name: str,
    right_name: str,
    spread: Sequence[str] = (),
    hot: Sequence[int] = (),
    measure: bool = False,
) -> DataFrame:
    """Left join on the normalised form of a name; equal names fan out."""
    keyed = left.withColumn("_name", join_name(left_name))
    ref = right.withColumn("_r_name", join_name(right_name)).drop(right_name)
    return lookup_join(
        keyed, ref, {"_name": "_r_name"}, "left", None, spread, hot, measure
    ).drop("_name")


def effective_join(
    sales: DataFrame,
    agreements: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str = "effective_from",
    end: str = "effective_to",
    spread: Sequence[str] = (),
    hot: Sequence[int] = (),
    measure: bool = False,
) -> DataFrame:
    """Left join to the agreements in force at a date.

    Equal keys plus an inclusive range whose end may be open. The equalities
    make it a hash or sort-merge join with the range as a residual condition.
    Overlapping windows yield one row each.
    """
    until = F.coalesce(F.col(end), F.lit(OPEN_END).cast("date"))
    in_force = (F.col(at) >= F.col(start)) & (F.col(at) <= until)
    return lookup_join(
        sales, agreements, {k: k for k in keys}, "left", in_force, spread, hot, measure
    ).drop(start, end)
