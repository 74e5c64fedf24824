"""Registered queries of the numbered operators, with production parameters."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm import hardneg, infill, language, leaks, lines, nearest, neardup, packing, quality, quotes, scoring, sharding, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(folds: int, fold: int) -> Column:
    """True where the id's checksum falls in the fold; a null id falls in none."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", _fold(7, 2))
    return scoring.score_documents(docs, tokenizer("byte_bpe_50k.tiktoken"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", _fold(5, 0).alias("held_out"))
    labels = _table(spark, sf_dir, "labels").where(~_fold(5, 0))
    return toxicity.score_toxicity(docs, labels, ["doc_id", "held_out"])


def op3_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), ["doc_id"])


def op4_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(_table(spark, sf_dir, "documents"), 40)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_recurring_lines(_table(spark, sf_dir, "documents"), length="n_chars")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").withColumn("asks", F.col("vec_id") % 20 == 0)
    return nearest.search(vectors, "asks", k=20)


def op7_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group_near_duplicates(_table(spark, sf_dir, "documents")).drop("class_key")


def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", _fold(4, 2))
    return language.identify(docs, docs.where(~F.col("held_out")), ["doc_id", "held_out"])


def op10_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(_table(spark, sf_dir, "conversations"))


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.fill_in_middle(_table(spark, sf_dir, "documents"), ["doc_id"])
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    return infill.restore(made, columns).drop("restored")


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", _fold(3, 1).alias("held_out"))
    labels = _table(spark, sf_dir, "labels").where(~_fold(3, 1))
    return quality.score_quality(docs, labels, ["doc_id", "held_out"])


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(vectors.withColumns({"label": moved, "anchor": F.col("vec_id") % 100 == 0}), "anchor")


_ALL = (
    op1_lm_scoring,
    op2_toxicity,
    op3_retrieval_packing,
    op4_feistel_sharding,
    op5_line_dedup,
    op6_nearest_neighbours,
    op7_minhash_neardup,
    op8_benchmark_leaks,
    op9_language_mixture,
    op10_quotation_linking,
    op11_infill,
    op12_quality,
    op13_hard_negatives,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


OP11_SQL = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id::VARCHAR) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l
  FROM documents
), drawn AS (
  SELECT doc_id, text, l, len(l) AS n,
    ('0x' || h[1:8])::BIGINT % (len(l) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(l) + 1) AS b,
    ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS d
  FROM lines
), cut AS (
  SELECT doc_id, text, n,
    array_to_string(l[1:least(a, b)], '') AS prefix,
    array_to_string(l[least(a, b) + 1:greatest(a, b)], '') AS middle,
    array_to_string(l[greatest(a, b) + 1:], '') AS suffix,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR c >= 100 THEN 'plain' WHEN d < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""


OP13_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    list_inner_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_infill": OP11_SQL, "op13_hard_negatives": OP13_SQL}
