"""A reproducible shuffle of rows into shards: a Feistel permutation of row numbers.

Rows are numbered 0 to n-1 in key order. The number is read as two digits of a
mixed radix a x b, with a*b at least n, and permuted by Feistel rounds; results
outside 0 to n-1 are permuted again (cycle walking) until they fall inside. The
permuted number gives shard and slot by division, so both can be computed for
any row number without looking at other rows.

Only DataFrame functions; the largest thing sent anywhere is one row for each
partition.
"""

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.shared import scratch, stored

#: Rounds of the permutation; each changes one of the two digits.
ROUNDS = 6


def radix(n: int) -> tuple[int, int]:
    """The two digit ranges for n numbers: a*b - n is less than a."""
    a = max(1, isqrt(n))
    return a, max(1, -(-n // a))


def feistel(number: Column, n: int, seed: int) -> Column:
    """One pass over 0 to a*b-1; a bijection of that range."""
    if n >= 2**53:
        raise ValueError("row numbers must stay below 2**53")
    a, b = radix(n)
    low = number % F.lit(a)
    high = ((number - low) / F.lit(a)).cast("long")  # exact: a multiple below 2**53
    for r in range(ROUNDS):
        mixed = F.pmod(F.xxhash64(low if r % 2 else high, F.lit(seed), F.lit(r)), F.lit(2_147_483_647))
        if r % 2:
            high = (high + mixed) % F.lit(b)
        else:
            low = (low + mixed) % F.lit(a)
    return high * F.lit(a) + low


def permuted(number: Column, n: int, seed: int, steps: int) -> Column:
    """The number's place in the shuffle of 0 to n-1: one pass, and up to
    ``steps`` more while it lies outside."""
    place = feistel(number, n, seed)
    if not steps:
        return place
    again = lambda x, _: F.when(x < n, x).otherwise(feistel(x, n, seed))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), place, again)


def walks(spark: SparkSession, n: int, seed: int) -> int:
    """How many more passes bring every number inside.

    A walk can only linger on the fewer than a numbers outside, which are all
    followed. Those that no pass brings inside turn in circles out there and are
    met from nowhere inside; they are the ones left when a pass frees no more.
    """
    a, b = radix(n)
    outside, left = spark.range(n, a * b), [a * b - n]
    while left[-1]:
        left.append(outside.where(permuted(F.col("id"), n, seed, len(left) - 1) >= n).count())
        if left[-1] == left[-2]:
            break
    return len(left) - 1 if not left[-1] else len(left) - 2


def numbered(df: DataFrame, by: list[str], name: str = "row_no") -> DataFrame:
    """``df`` with gapless row numbers in the order of ``by``, nulls first.

    ``df`` is range-partitioned and sorted; a partition's first number is the sum
    of the sizes before it. Rows that tie on all of ``by`` are in any order.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with scratch(spark) as kept:
        placed = kept.stored(
            df.repartitionByRange(parts, *by)
            .sortWithinPartitions(*by)
            .withColumn("__part", F.spark_partition_id())
            # The low 33 bits count the rows of the partition.
            .withColumn("__at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
            "placed",
        )
        sizes = placed.groupBy("__part").count().collect()  # one row a partition
        first, firsts = 0, []
        for row in sorted(sizes):
            firsts.append((row["__part"], first))
            first += row["count"]
        starts = spark.createDataFrame(firsts, "__part int, __first long")
        return stored(
            placed.join(F.broadcast(starts), "__part").withColumn(name, F.col("__first") + F.col("__at")).drop("__part", "__at", "__first"),
            "numbered",
        )


def shard_rows(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", seed: int = 17) -> DataFrame:
    """Spread rows over shards in shuffled order; counts differ by one at most.

    Rows: doc_id, size (UTF-8 bytes of the text, null as none, plus 16),
    text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard
    (null: this law moves rows when a shard is added), row_no.
    Numbers follow (id, checksum, size), nulls first; equal rows share a place in
    that order and get neighbouring numbers in either order. No rows: no rows.
    Other columns are not read.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    digest = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + F.lit(16)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    rows = numbered(digest, ["doc_id", "text_crc32", "size"])
    n = rows.count()
    place = permuted(F.col("row_no"), n, seed, walks(docs.sparkSession, n, seed)) if n else F.col("row_no")
    return rows.withColumn("__place", place).select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("__place") % shards).cast("int").alias("shard"),
        ((F.col("__place") - F.col("__place") % shards) / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_no",
    )
