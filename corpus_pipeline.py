"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes what the one before kept, written as Parquet and read again.
All but the last return the columns of their input.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm import language, leaks, lines, neardup, packing
from turnstile.llm.queries import tokenizer
from turnstile.llm.shared import Marks, scratch, stored, without

#: A document whose main language has a smaller share than this is rejected.
LEAST_SHARE = 0.4

#: Most bytes of rows that a task gives to Python at once. Of a batch both sides hold several
#: copies, and much of that room is not given back; Spark's own limit is 64 MB.
BATCH_BYTES = 4 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """For the session, as the plans that stages return run later. A limit that it was given stays."""
    if spark.conf.get(_BATCHES, None) is None:
        spark.conf.set(_BATCHES, str(BATCH_BYTES))


def _numbered_columns(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns c0, c1, ... and the new names by the old: no name of
    the input can then clash with one that an operator adds."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(new).alias(old) for old, new in names.items()))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or with no language of a fair share, go.

    Learns from the labelled documents outside one fold of four; null labels
    are not learned from. Null and empty texts have no letter.
    """
    _small_batches(spark)
    plain, names = _numbered_columns(docs)
    fold = F.coalesce(F.crc32(F.col(names["doc_id"]).cast("string")) % 4 == 2, F.lit(False))
    found = language.identify(plain, plain.where(~fold), list(names.values()), text=names["text"], lang=names["lang"], doc_id=names["doc_id"])
    return _back(found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)), names)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines stay in their first document; one left without any goes.
    Null and blank texts stay."""
    plain, names = _numbered_columns(docs)
    left = lines.drop_recurring_lines(plain, names["doc_id"], names["text"], length=names.get("n_chars"))
    return _back(left.where((F.col("lines_dropped") == 0) | F.col(names["text"]).rlike(r"\S")), names)


def _marked(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """With a column that tells the texts of a repeated id apart."""
    return docs.withColumn("mark", F.xxhash64(names["text"]))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id.

    Of equal rows one stays, unlike texts of one id are each judged on their own;
    rows without id all stay.
    """
    _small_batches(spark)
    plain, names = _numbered_columns(docs)
    marked, key = _marked(plain, names), names["doc_id"]
    classes = neardup.group_near_duplicates(marked, key, names["text"], keep=["mark"])
    rows = classes.where(F.col("class_size") > 1).select(F.col("doc_id").alias(key), "mark", "class_key")
    first = rows.groupBy("class_key").agg(F.min(F.struct(key, "mark")).alias("stays"))
    others = rows.join(first, "class_key").where(F.struct(key, "mark") != F.col("stays")).select(key, "mark").distinct()
    left = without(marked, stored(others, "near-duplicates"), [key, "mark"])
    equal = stored(rows.groupBy(key, "mark").count().where("count > 1").select(key, "mark"), "equal-rows")
    if equal.limit(1).count():
        # Only rows that repeat both id and text meet again to leave one of each.
        some, rest = Marks(equal.select(F.xxhash64(key, "mark").alias("k")), "k").split(left, F.xxhash64(key, "mark"))
        repeated = some.join(equal, [key, "mark"], "left_semi")
        left = rest.unionByName(some.join(equal, [key, "mark"], "left_anti")).unionByName(repeated.dropDuplicates([key, "mark"]))
    return _back(left, names)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, copied or edited, go."""
    _small_batches(spark)
    plain, names = _numbered_columns(docs)
    on = [names["doc_id"], "mark"]
    marked = _marked(plain, names)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = stored(leaks.find_leaks(marked, items, on, text=names["text"]).select(*on).distinct(), "leaks")
    return _back(without(marked, found, on), names)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of what is left, in sequences of one window."""
    _small_batches(spark)
    plain, names = _numbered_columns(docs)
    packed = packing.pack(plain, tokenizer("byte_bpe_50k.json"), [names["doc_id"]], text=names["text"])
    return packed.withColumnRenamed(names["doc_id"], "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: No stage but the second could be written in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    (*first, (name, last)) = STAGES
    given = spark.conf.get(_BATCHES, None)
    # What a stage has read is given up as soon as the one after it is written.
    try:
        with scratch(spark) as kept:
            for step, stage in first:
                docs = kept.stored(stage(spark, docs, sf_dir), step)
            return stored(last(spark, docs, sf_dir), name)
    finally:
        if given is None:
            spark.conf.unset(_BATCHES)
