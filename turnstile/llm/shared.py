"""Helpers of the operators: stored intermediate tables and Arrow batches."""

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.session import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    Cuts the lineage: a later loss of executors repeats nothing above it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables under one folder, given up together."""

    def __init__(self, spark: SparkSession):
        self._spark, self._root, self._count = spark, scratch_dir(spark, "scratch"), 0
        self._files = None

    def sized(self, rows: int, each: int) -> None:
        """What is stored from now on follows from so many rows: a file for ``each`` of them,
        or four for a core, are enough, however many partitions a shuffle has.

        Each file costs an executor several processes that set permissions where the
        folder is a local one; while one starts, its executor's memory counts twice.
        """
        self._files = max(4 * self._spark.sparkContext.defaultParallelism, rows // each)

    def gathered(self, df: DataFrame) -> DataFrame:
        return df if self._files is None else df.coalesce(self._files)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        self._count += 1
        path = f"{self._root}/{self._count}-{name}"
        self.gathered(df).write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Free the space; an overwrite with no rows is the portable delete."""
        if self._count:
            self._spark.range(0).coalesce(1).write.mode("overwrite").parquet(self._root)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Tables for the block's time. What leaves the block must be ``stored`` on its own."""
    own = Scratch(spark)
    try:
        yield own
    finally:
        own.release()


#: A set of marks has so many bits for a key, 2**_MOST in all at most (32 MB).
_BITS_A_KEY, _LEAST, _MOST = 32, 20, 28
#: Bits of one row of marks, the size that Spark's bitmap aggregate has.
_ROW_BITS = 1 << 15


class Marks:
    """A bitmap of hashed keys, for tasks to tell rows that cannot match before they
    are shuffled.

    Of bounded size whatever the number of keys: with very many it lets more rows
    pass that match nothing, and in the end all, so what follows must still be exact.
    """

    def __init__(self, keys: DataFrame, key: str):
        n = keys.count()
        self.bits = min(_MOST, max(_LEAST, (n * _BITS_A_KEY).bit_length()))
        row, bits = self._places(F.col(key))
        # A row for each stretch of the bitmap: 8,192 of 4 KB at most.
        marked = keys.select(row.alias("mark_row"), F.explode(F.array(*bits)).alias("bit"))
        self.rows = marked.groupBy("mark_row").agg(F.bitmap_construct_agg("bit").alias("marks"))

    def _places(self, key: Column) -> tuple[Column, list[Column]]:
        """A key's stretch of the bitmap and its two bits there."""
        hashed = F.xxhash64(key)
        row = F.shiftrightunsigned(hashed, 40).bitwiseAND((1 << (self.bits - 15)) - 1)
        return row, [hashed.bitwiseAND(_ROW_BITS - 1), F.shiftrightunsigned(hashed, 20).bitwiseAND(_ROW_BITS - 1)]

    def split(self, df: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
        """Rows of ``df`` whose key may be among the keys, and those whose key is not."""
        row, bits = self._places(key)

        def held(bit: Column) -> Column:
            byte = F.ascii(F.decode(F.substring("marks", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
            return F.getbit(byte, bit.bitwiseAND(7).cast("int")) == 1

        marked = F.coalesce(held(bits[0]) & held(bits[1]), F.lit(False))
        joined = df.withColumn("mark_row", row).join(F.broadcast(self.rows), "mark_row", "left")
        return tuple(joined.where(marked == found).select(*(F.col(f"`{c}`") for c in df.columns)) for found in (True, False))

    def within(self, df: DataFrame, key: Column) -> DataFrame:
        return self.split(df, key)[0]


def without(df: DataFrame, gone: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose columns ``on`` are no row of ``gone``; nulls are equal.
    Only rows that may be one are shuffled. ``gone`` is read twice: a stored table."""
    names = [f"gone_{i}" for i in range(len(on))]
    keys = gone.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(on, names, strict=True)))
    marks = Marks(keys.select(F.xxhash64(*names).alias("gone_key")), "gone_key")
    some, others = marks.split(df, F.xxhash64(*(F.col(f"`{c}`") for c in on)))
    equal = reduce(Column.__and__, (some[f"`{c}`"].eqNullSafe(F.col(n)) for c, n in zip(on, names, strict=True)))
    return some.join(keys, equal, "left_anti").unionByName(others)


#: Rows of a batch that are made Python's own at once.
_SLICE = 512


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into smaller ones, so that little of one is held as Python's own."""
    for b in batches:
        for i in range(0, b.num_rows, _SLICE):
            yield b.slice(i, _SLICE)


def raw(column: pa.Array) -> list:
    """UTF-8 bytes of a text column, None for null."""
    return column.cast(pa.large_binary()).to_pylist()


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: Odd multiplier of the words' polynomial, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes whose words are hashed in one go.
_BLOCK = 1 << 20
SPACES = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
#: White space and all other ASCII signs that are neither letter nor digit.
SIGNS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def _powers(base: int, n: int, _held: dict = {}) -> np.ndarray:  # noqa: B006
    held = _held.get(base)
    if held is None or len(held) < n:
        steps = np.full(max(n, _BLOCK + 1), base, np.uint64)
        steps[0] = 1
        held = _held[base] = np.cumprod(steps)
    return held[:n]


def _hashed(texts: list[bytes], kinds: np.ndarray) -> list[np.ndarray]:
    sizes = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    kind = kinds[data]
    change = np.flatnonzero(np.diff(kind, prepend=np.int8(0)))
    start, end = change[kind[change] > 0], change[kind[change - 1] > 0] if len(change) else change
    # Sums of a polynomial over the bytes so far; a word's part of them, moved to
    # its own start, does not depend on where the word stands.
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)))
    before = np.where(start > 0, sums[start - 1], np.uint64(0)) if len(start) else np.zeros(0, np.uint64)
    hashes = (sums[end - 1] - before) * _powers(_INVERSE, len(data))[start]
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(29)
    return np.split(hashes, np.searchsorted(start, np.cumsum(sizes)[:-1]))


def word_hashes(column: pa.Array, apart: np.ndarray) -> Iterator[np.ndarray]:
    """64-bit hashes of the lower-cased words of each text, null as empty.
    ``apart``: the bytes between words; white space must be among them."""
    return token_hashes(column, (~apart).astype(np.int8))


def token_hashes(column: pa.Array, kinds: np.ndarray) -> Iterator[np.ndarray]:
    """64-bit hashes of the tokens of each lower-cased text, null as empty: longest
    stretches of bytes of one kind. ``kinds``: of each byte, 0 for those between
    tokens; white space must be among them."""
    block, size = [], 0
    for i in range(0, len(column), _SLICE):
        for text in raw(pc.utf8_lower(column.slice(i, _SLICE))):
            block.append(text or b"")
            size += len(block[-1]) + 1
            if size >= _BLOCK:
                yield from _hashed(block, kinds)
                block, size = [], 0
    if block:
        yield from _hashed(block, kinds)
