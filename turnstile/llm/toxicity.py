"""Toxicity by gradient-boosted trees over dense text features, then isotonic calibration.

The lexicon is learned: words and word beginnings that are far more frequent in
documents labelled toxic. Features of a document are densities of the lexicon,
plain and behind obfuscation, its nearness to words of the second person,
capitals, punctuation and obfuscation rates. Trees and calibration are Spark ML's.
"""

import re
from collections import Counter
from collections.abc import Callable
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.shared import batch, scratch

#: Words of the second person.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer sie ihnen tú ti usted ustedes vosotros".split()
)
#: Letters that stand in for others.
_LEET = str.maketrans("013457@$!|", "oieastasil")
#: Lengths of word beginnings in the lexicon.
PREFIXES = (4, 5, 6)
#: A lexicon word so many words from one of the second person is near.
NEAR = 5
#: Words whose traits a task remembers.
_REMEMBERED = 200_000

FEATURES = (
    "log_words", "word_density", "prefix_density", "hidden_density", "word_hits", "prefix_hits", "hidden_hits", "strongest",
    "near_second_person", "second_person", "capital_words", "capital_letters", "exclamations", "questions", "punctuation",
    "digits_inside", "symbols_inside", "drawn_out",
)

#: What a word adds to the features.
TRAITS = (
    "whole", "start", "hidden", "odds", "person", "capital", "capitals", "exclamations", "questions",
    "signs", "digits_inside", "symbols_inside", "drawn_out", "length",
)

_TERMS = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("other", pa.int64())])


_DRAWN = re.compile(r"(.)\1{2,}")


def plain(word: str) -> str:
    """The lower-cased word without what is not a letter at either end."""
    core = word.strip(punctuation)
    if core.isalpha():  # nearly all words
        return core.lower()
    low = word.lower()
    start, end = 0, len(low)
    while start < end and not low[start].isalpha():
        start += 1
    while end > start and not low[end - 1].isalpha():
        end -= 1
    return low[start:end]


def revealed(word: str) -> str:
    """The word with look-alike signs as letters, others taken out, drawn-out letters once."""
    letters = "".join(c for c in word.lower().strip(".,;:!?\"'()").translate(_LEET) if c.isalpha())
    return _DRAWN.sub(r"\1", letters)


def terms(word: str) -> list[str]:
    """Lexicon entries that the word could match: itself and its beginnings, marked."""
    low = plain(word)
    return [low, *(f"{low[:n]}^" for n in PREFIXES if len(low) > n)] if low else []


def _term_counts(batches):
    toxic, other = Counter(), Counter()
    for b in batches:
        for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True):
            (toxic if label else other).update({t for w in set((text or "").split()) for t in terms(w)})
    names = list(toxic.keys() | other.keys())
    yield batch(_TERMS, names, [toxic[t] for t in names], [other[t] for t in names])


def learn_lexicon(rows: DataFrame, size: int, least: int, odds: float) -> dict[str, float]:
    """Log odds by term: ``least`` toxic documents hold it, in a share ``odds`` times
    that of the others; the ``size`` strongest."""
    found = rows.mapInArrow(_term_counts, "term string, toxic long, other long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    totals = rows.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other")).first()
    ratio = ((F.col("toxic") + 0.5) / (totals["toxic"] + 1)) / ((F.col("other") + 0.5) / (totals["other"] + 1))
    top = found.withColumn("odds", F.log(ratio)).where((F.col("toxic") >= least) & (ratio >= odds)).orderBy(F.desc(F.col("odds") * F.log(F.col("toxic"))), "term").limit(size)
    return {r["term"]: r["odds"] for r in top.collect()}


class _Places(dict):
    """Row numbers of words; a new word is given one."""

    def __init__(self, add: Callable[[str], int]):
        super().__init__()
        self._add = add

    def __missing__(self, word: str) -> int:
        self[word] = at = self._add(word)
        return at


class Traits:
    """Features of texts; a word's part in them is worked out once."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.known = lexicon, _Places(self._place)
        self.rows, self.used = np.zeros((1024, len(TRAITS)), np.float32), 0

    def _place(self, word: str) -> int:
        if self.used == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.used] = self._traits(word)
        self.used += 1
        return self.used - 1

    def _traits(self, word: str) -> tuple:
        low = plain(word)
        clean = word.strip(punctuation).isalpha()
        drawn = bool(_DRAWN.search(low))
        # A word of letters hides nothing but by repeating them.
        bare = low if clean and not drawn else revealed(word)
        odds = self.lexicon.get
        begins = lambda w: max((odds(f"{w[:n]}^", 0.0) for n in PREFIXES if len(w) > n), default=0.0)
        whole, start = odds(low, 0.0), begins(low)
        hidden = 0.0 if whole or start or bare == low else max(odds(bare, 0.0), begins(bare))
        letters = len(low) if clean else sum(map(str.isalpha, word))
        inside = "" if clean else word.strip(".,;:!?\"'()[]*#$%&-_")
        return (
            whole > 0, start > 0, hidden > 0, max(whole, start, hidden), low in SECOND_PERSON,
            letters > 1 and word.isupper(), 0 if word.islower() else sum(map(str.isupper, word)), word.count("!"), word.count("?"),
            len(word) - letters - (0 if clean else sum(map(str.isdigit, word))), letters > 0 and any(map(str.isdigit, inside)),
            letters > 0 and any(not c.isalnum() and c not in "'-’" for c in inside), drawn, len(word),
        )

    def _ids(self, words: list[str]) -> list[int]:
        if self.used > _REMEMBERED:
            self.known.clear()
            self.used = 0
        return list(map(self.known.__getitem__, words))

    def table(self, texts: list[str | None]) -> np.ndarray:
        """A row of FEATURES for each text."""
        out = np.zeros((len(texts), len(FEATURES)))
        for i, text in enumerate(texts):
            words = (text or "").split()
            if not words:
                continue
            ids = self._ids(words)
            rows = self.rows[ids]
            total, n = rows.sum(axis=0, dtype=float), len(words)
            bad = np.flatnonzero(rows[:, 3] > 0)
            near = 0
            if len(bad) and total[4]:
                person = np.flatnonzero(rows[:, 4])
                at = np.searchsorted(person, bad)
                left = bad - person[np.maximum(at - 1, 0)]
                right = person[np.minimum(at, len(person) - 1)] - bad
                near = (np.minimum(np.abs(left), np.abs(right)) <= NEAR).sum()
            letters = max(1.0, total[13])
            out[i] = (
                np.log1p(n), total[0] / n, total[1] / n, total[2] / n, total[0], total[1], total[2], rows[:, 3].max(),
                near / n, total[4] / n, total[5] / n, total[6] / letters, total[7] / n, total[8] / n, total[9] / letters,
                total[10] / n, total[11] / n, total[12] / n,
            )
        return out


def _featured(lexicon: Callable[[], dict], schema: pa.Schema) -> Callable:
    def run(batches):
        traits = Traits(lexicon())
        for b in batches:
            kept = [b.column(n) for n in schema.names[:-1]]
            yield batch(schema, *kept, list(traits.table(b.column("__text").to_pylist())))

    return run


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    keep: list[str],
    text: str = "text",
    label: str = "toxic",
    doc_id: str = "doc_id",
    sample_rows: int = 20_000,
    lexicon_size: int = 2_000,
    least: int = 3,
    odds: float = 8.0,
    trees: int = 12,
    depth: int = 3,
) -> DataFrame:
    """The columns ``keep`` of each row of ``docs``, with score (0 to 1) and predicted.

    ``labels``: ids and 0/1 labels of the rows of ``docs`` to learn from; about
    ``sample_rows`` of them are used, picked by a hash of the id, or all if there
    are fewer, and sent to the documents. A quarter of the sample calibrates, the
    rest grows the trees. Null ids and labels are left out. Null and empty texts are scored on their
    zero features. With labels of one kind only, that kind's share is every score.
    Ties and equal rows score alike and all return.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession

    def features(rows: DataFrame, names: list[str], lexicon) -> DataFrame:
        kept = rows.select(*names)
        out = kept.withColumn("__features", F.array(F.lit(0.0))).schema
        return rows.select(*names, F.col(text).cast("string").alias("__text")).mapInArrow(_featured(lambda: lexicon.value, to_arrow_schema(out)), out)

    chosen = labels.select(F.col(doc_id).alias("id"), (F.col(label) > 0).cast("int").alias("label")).dropna()
    n = chosen.count()
    scale = 1_000_000
    hashed = F.xxhash64("id")
    if n > sample_rows:
        chosen = chosen.where(F.pmod(hashed, F.lit(scale)) < int(scale * sample_rows / n))
    known = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    with scratch(spark) as kept:
        sample = kept.stored(
            known.join(F.broadcast(chosen), "id").select("text", "label", (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0).alias("calibrates")),
            "toxic-sample",
        )
        kinds = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
        if kinds["toxic"] in (0, kinds["n"]):
            share = kinds["toxic"] / kinds["n"] if kinds["n"] else 0.0
            return docs.select(*keep, F.lit(float(share)).alias("score"), F.lit(int(share >= 0.5)).alias("predicted"))
        lexicon = spark.sparkContext.broadcast(learn_lexicon(sample.where(~F.col("calibrates")), lexicon_size, least, odds))
        # Rare toxic rows weigh as much as the others.
        weight = F.when(F.col("label") == 1, F.lit(kinds["n"] / (2 * kinds["toxic"]))).otherwise(F.lit(kinds["n"] / (2 * (kinds["n"] - kinds["toxic"]))))
        table = kept.stored(
            features(sample.withColumnRenamed("text", text) if text != "text" else sample, ["label", "calibrates"], lexicon).withColumn("weight", weight), "toxic-features"
        ).withColumn("features", array_to_vector("__features"))
        grown = GBTClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=17, maxBins=32
        ).fit(table.where(~F.col("calibrates")).coalesce(6))
        level = vector_to_array("probability").getItem(1)
        calibrating = grown.transform(table.where("calibrates")).select(level.alias("level"), F.col("label").cast("double").alias("label"))
        # Without calibration rows of both kinds the trees' own probability stands.
        both = calibrating.agg(F.countDistinct("label").alias("k")).first()["k"] == 2
        curve = IsotonicRegression(featuresCol="level", labelCol="label").fit(calibrating) if both else None
    scored = grown.transform(features(docs, keep, lexicon).withColumn("features", array_to_vector("__features"))).withColumn("level", level)
    if curve:
        # Between equal steps the trees' own level still orders documents.
        scored = curve.setPredictionCol("calibrated").transform(scored.drop("prediction"))
        scored = scored.withColumn("score", F.col("calibrated") * 0.98 + F.col("level") * 0.02)
    else:
        scored = scored.withColumn("score", F.col("level"))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))
    return scored.select(*keep, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
