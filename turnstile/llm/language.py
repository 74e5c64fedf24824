"""Language proportions of a document by expectation-maximisation over n-grams.

Each letter trigram of a text is drawn from one of the languages; the shares of
the languages are fitted to the text, and the set of languages is the one of
best likelihood less a penalty for each language in it.
"""

from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.shared import batch, parts

#: Trigrams are counted by hash.
CELLS = 1 << 16
_SPACE = 32
#: Characters of a text that are looked at in one go.
_BLOCK = 1 << 18
#: Languages below this share are tried together, before each one on its own.
_TRACE = 0.02

_TALLY = pa.schema([("lang", pa.string()), ("cell", pa.int32()), ("n", pa.int64())])


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The letter trigrams of the lower-cased text, words apart by a space: hashes,
    ascending, and their counts. A text of any length yields CELLS hashes at most and
    is read in blocks."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    total, some, inside, tail = None, False, True, np.array([_SPACE], np.uint64)
    for start in range(0, len(codes) + 1, _BLOCK):
        block = codes[start : start + _BLOCK]
        letters = _letters()[block]
        some |= bool(letters.any())
        # A space for each run of other characters, and one at either end.
        held = np.where(letters, block, _SPACE)[letters | np.r_[inside, letters[:-1]][: len(block)]]
        inside = bool(letters[-1]) if len(block) else inside
        end = [_SPACE] if start + _BLOCK > len(codes) else []
        held = np.r_[tail, held.astype(np.uint64), np.array(end, np.uint64)]
        tail = held[-2:]
        mixed = (held[:-2] * np.uint64(0x9E3779B1) + held[1:-1]) * np.uint64(0x85EBCA77) + held[2:]
        cells = ((mixed * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(48)).astype(np.int64)
        if len(codes) < _BLOCK:
            return np.unique(cells if some else cells[:0], return_counts=True)
        total = np.bincount(cells, minlength=CELLS) + (0 if total is None else total)
    found = np.flatnonzero(total) if some else np.zeros(0, np.int64)
    return found, total[found]


def _tally(batches):
    found: dict[str, np.ndarray] = {}
    for b in parts(batches):
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            cells, counts = trigrams(text)
            if len(cells):
                found.setdefault(lang, np.zeros(CELLS, np.int64))[cells] += counts
    for lang, own in found.items():
        used = np.flatnonzero(own)
        yield batch(_TALLY, [lang] * len(used), used, own[used])


class Mixture:
    """Fits language shares to one text at a time."""

    def __init__(self, langs: list[str], chances: np.ndarray, penalty: float, rounds: int):
        # By trigram: all that is known of one is in one place.
        self.langs, self.chances = langs, np.ascontiguousarray(chances.T)
        self.penalty, self.rounds = penalty, rounds

    def _shares(self, p: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
        """Shares and log likelihood of trigrams that occur so many ``times``."""
        shares = np.full(p.shape[1], 1 / p.shape[1])
        for _ in range(self.rounds):
            seen = p @ shares
            new = shares * ((times / seen) @ p) / times.sum()
            done = np.abs(new - shares).max() < 1e-4
            shares = new
            if done:
                break
        return shares, float(times @ np.log(p @ shares))

    def fit(self, text: str | None) -> list[tuple[str, float]]:
        """Languages and shares, largest first; none if the text has no letter."""
        cells, times = trigrams(text)
        if not len(cells) or not self.langs:
            return []
        p = self.chances[cells]
        among = np.arange(len(self.langs))
        shares, fit = self._shares(p, times)
        cost = self.penalty * np.log(times.sum() + 1)
        keep = shares >= min(_TRACE, shares.max())
        if not keep.all():
            fewer, worse = self._shares(p[:, keep], times)
            # None of them would be missed more than all of them are.
            if fit - worse <= cost:
                among, shares, fit = among[keep], fewer, worse
        left = True
        while left and len(among) > 1:
            left = False
            for i in among[np.argsort(shares)]:
                rest = among[among != i]
                fewer, worse = self._shares(p[:, rest], times)
                if fit - worse <= cost:
                    among, shares, fit, left = rest, fewer, worse, True
                    break
        shares = shares / shares.sum()
        order = sorted(range(len(among)), key=lambda k: (-shares[k], self.langs[among[k]]))
        return [(self.langs[among[k]], float(shares[k])) for k in order]


def learn(docs: DataFrame, text: str, lang: str, doc_id: str, sample_rows: int) -> tuple[list[str], np.ndarray]:
    """Languages and, by language, the chance of each trigram cell.

    Learns from about ``sample_rows`` labelled rows, picked by a hash of id and
    text, or from all if there are fewer. At most languages x cells numbers
    reach the driver.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), F.col(doc_id).alias("doc_id")).where(
        F.col("lang").isNotNull()
    )
    n = rows.select("lang").count()
    scale = 1_000_000
    if n > sample_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(scale)) < int(scale * sample_rows / n))
    cells = rows.select("lang", "text").mapInArrow(_tally, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = cells.groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("cells")).orderBy("lang").collect()
    counts = np.full((len(found), CELLS), 0.5)
    for k, row in enumerate(found):
        for cell, times in row["cells"]:
            counts[k, cell] += times
    return [r["lang"] for r in found], counts / counts.sum(axis=1, keepdims=True) if len(found) else counts


def _identifying(model: Callable[[], tuple], text: str, schema: pa.Schema) -> Callable:
    def run(batches):
        mixture = Mixture(*model())
        for b in parts(batches):
            best, score, shares = [], [], []
            for found in map(mixture.fit, b.column(text).to_pylist()):
                best.append(found[0][0] if found else "und")
                score.append(min(1.0, found[0][1]) if found else 0.0)
                shares.append([{"lang": k, "share": s} for k, s in found])
            kept = [b.column(n) for n in schema.names[: len(schema) - 3]]
            yield batch(schema, *kept, best, score, shares)

    return run


def identify(
    docs: DataFrame,
    labelled: DataFrame,
    keep: list[str],
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    sample_rows: int = 20_000,
    penalty: float = 3.0,
    rounds: int = 12,
) -> DataFrame:
    """The columns ``keep`` of each row of ``docs``, with lang_pred, score, languages.

    lang_pred: the language of largest share, ``und`` for a text that is null or
    has no letter (score 0, no languages). score: that share. languages: all
    shares of the chosen set. Texts are read whole; a long one takes time and room by
    its distinct trigrams, of which there are ``CELLS`` at most. ``labelled`` gives the rows
    to learn from; with none every text is ``und``. Equal rows all return; ties
    go to the first language by name. A column of ``docs`` that is not kept may
    have any name.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    langs, chances = learn(labelled, text, lang, doc_id, sample_rows)
    model = docs.sparkSession.sparkContext.broadcast((langs, chances, penalty, rounds))
    kept = docs.select(*keep)
    own = docs.select(F.col(text)).schema[0]
    # Texts that are kept go to Python once.
    held = text in keep and own.dataType == T.StringType()
    rows = kept if held else docs.select(*keep, F.col(text).cast("string").alias("__text"))
    out = kept.withColumns(
        {"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0), "languages": F.array(F.struct(F.lit("").alias("lang"), F.lit(0.0).alias("share")))}
    ).schema
    for field in out.fields:
        field.nullable = True
    return rows.mapInArrow(_identifying(lambda: model.value, own.name if held else "__text", to_arrow_schema(out)), out)
