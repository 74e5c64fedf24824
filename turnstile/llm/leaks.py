"""Benchmark passages in documents: rare n-gram seeds, then Smith-Waterman alignment.

An item's seeds are its rarest word n-grams, by the number of documents of the
whole corpus that hold them. A seed in a document points at the stretch where
the item would lie; stretches are aligned with the item word by word, which
scores edited and paraphrased copies too.

Items are sent to every task in blocks of a stated size; the corpus is read once
for the counts and once for the search of each block, and is never shuffled.
"""

from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.shared import SIGNS, batch, scratch, stored, word_hashes

MATCH, MISMATCH, GAP = 2, -1, -1
_COUNTS = pa.schema([("seed", pa.int64()), ("n", pa.int64())])
#: Bits of the table that tells at once that an n-gram is no seed.
_SIEVE = 22


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    """Word hashes: lower-cased runs of letters, digits and other non-ASCII signs."""
    return list(word_hashes(pa.array(texts, pa.string()), SIGNS))


#: Bytes of the items of a block.
BLOCK_BYTES = 16 << 20


class Sieve:
    """Finds the few n-grams that are among the codes."""

    def __init__(self, codes: np.ndarray):
        self.codes, self._table = codes, np.zeros(1 << _SIEVE, bool)
        self._table[codes & ((1 << _SIEVE) - 1)] = True

    def hits(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``found`` and in the codes where they are equal."""
        near = np.flatnonzero(self._table[found & ((1 << _SIEVE) - 1)])
        if not len(near):
            return near, near
        at = np.minimum(np.searchsorted(self.codes, found[near]), len(self.codes) - 1)
        same = self.codes[at] == found[near]
        return near[same], at[same]


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on."""
    if len(words) < n:
        return np.zeros(0, np.int64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = (out ^ words[k : len(words) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def align(item: np.ndarray, stretch: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: its score, and the first and the past-the-last word of
    the stretch in it. Linear gap costs, so a row's gaps are a running maximum."""
    width = len(stretch)
    steps = np.arange(width + 1) * -GAP
    score, since = np.zeros(width + 1, np.int64), np.arange(width + 1)
    best = (0, 0, 0)
    for word in item:
        pair = np.where(stretch == word, MATCH, MISMATCH)
        new, start = np.zeros(width + 1, np.int64), np.arange(width + 1)
        up, diagonal = score + GAP, score[:-1] + pair
        take = up > new
        new[take], start[take] = up[take], since[take]
        take = np.r_[False, diagonal >= new[1:]] & np.r_[False, diagonal > 0]
        new[take], start[take] = diagonal[take[1:]], since[:-1][take[1:]]
        # A gap along the stretch: the best cell to the left, less its distance.
        level = new + steps
        run = np.maximum.accumulate(level)
        from_at = np.maximum.accumulate(np.where(level == run, np.arange(width + 1), 0))
        left = run - steps
        take = left > new
        new[take], start[take] = left[take], start[from_at[take]]
        score, since = new, start
        at = int(score.argmax())
        if score[at] > best[0]:
            best = int(score[at]), int(since[at]), at
    return best


def _counting(seeds: Callable[[], np.ndarray], n: int) -> Callable:
    def run(batches):
        sieve = Sieve(seeds())
        counts = np.zeros(len(sieve.codes), np.int64)
        for b in batches:
            for words in word_hashes(b.column("text"), SIGNS):
                counts[np.unique(sieve.hits(ngrams(words, n))[1])] += 1
        used = np.flatnonzero(counts)
        yield batch(_COUNTS, sieve.codes[used], counts[used])

    return run


class Seeds:
    """Where seeds stand in which items."""

    def __init__(self, items: dict, n: int, chosen: dict):
        self.items = items
        places = defaultdict(list)
        for item, words in items.items():
            for at, gram in enumerate(ngrams(words, n).tolist()):
                if gram in chosen[item]:
                    places[gram].append((item, at))
        self.codes = np.array(sorted(places), np.int64)
        self.places = [places[c] for c in self.codes.tolist()]
        self.n, self.sieve = n, None

    def stretches(self, words: np.ndarray) -> list[tuple[object, int, int]]:
        """(item, from, to) to align: around each seed as far as the item could
        reach with a fifth of its length in insertions; overlapping ones as one."""
        # Made where it is used: the table is larger than the codes.
        self.sieve = self.sieve or Sieve(self.codes)
        spans = defaultdict(list)
        for place, code in zip(*(x.tolist() for x in self.sieve.hits(ngrams(words, self.n))), strict=True):
            for item, within in self.places[code]:
                length = len(self.items[item])
                slack = length // 5 + 3
                spans[item].append((max(0, place - within - slack), min(len(words), place + length - within + slack)))
        out = []
        for item, parts in spans.items():
            parts.sort()
            start, end = parts[0]
            for a, b in parts[1:]:
                # A long run of copies is aligned in pieces, each long enough for one.
                if a <= end and b - start <= 4 * len(self.items[item]) + 64:
                    end = max(end, b)
                else:
                    out.append((item, start, end))
                    start, end = a, b
            out.append((item, start, end))
        return out


def _searching(seeds: Callable[[], Seeds], least: float, schema: pa.Schema) -> Callable:
    def run(batches):
        own = seeds()
        for b in batches:
            at, rows = [], []
            for i, tokens in enumerate(word_hashes(b.column("__text"), SIGNS)):
                best: dict = {}
                for key, start, end in own.stretches(tokens):
                    score, first, last = align(own.items[key], tokens[start:end])
                    share = score / (MATCH * len(own.items[key]))
                    item = key[0]  # that the table may repeat with several texts
                    if share >= least and (item not in best or share > best[item][0]):
                        best[item] = share, start + first, start + last
                for item, (share, first, last) in best.items():
                    at.append(i)
                    rows.append((item, share, first, last))
            take = pa.array(at, pa.int64())
            kept = [b.column(n).take(take) for n in schema.names[: len(schema) - 4]]
            yield batch(schema, *kept, *([r[k] for r in rows] for k in range(4)))

    return run


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = 3,
    rare_share: float = 0.75,
    least: float = 0.5,
    block: int = 20_000,
) -> DataFrame:
    """A row for each document and item whose passage it holds, copied or edited.

    Rows: the columns ``keep`` of the document, item_id, score (alignment score as
    a share of the item's own), first_word, past_word (the stretch, in words, which
    are apart by white space or ASCII signs). ``rare_share``: so much of an item's n-grams, the
    rarest by documents of the corpus and all that tie with the last, are its
    seeds. ``least``: from this score on it counts. ``block``: items that are
    sent to the tasks at once, or fewer if long; more are searched block by block.

    Items of fewer than ``n`` words and null texts on either side match nothing.
    Items of equal text are reported each; repeated documents each. A document
    with several copies of an item gives one row, of the best copy, the first at
    a tie. An id of ``items`` with several texts is found by any of them, in one row,
    that of the best. Texts of any length are searched whole.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    kind = items.select(F.col(item_id)).schema[0].dataType
    out = docs.select(*keep).withColumns({"item_id": F.lit(None).cast(kind), "score": F.lit(0.0), "first_word": F.lit(0).cast("long"), "past_word": F.lit(0).cast("long")}).schema
    for field in out.fields:
        field.nullable = True
    schema = to_arrow_schema(out)
    own = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text is not null and item_id is not null").distinct()
    size = own.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // block), -(-size["bytes"] // BLOCK_BYTES))
    found = None
    with scratch(spark) as kept:
        for k in range(blocks):
            # All texts of an item are in one block.
            part = own.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else own
            listed = sorted(part.collect(), key=lambda r: r["text"])  # a block at most, give or take its hash share
            texts = {(r["item_id"], i): w for i, (r, w) in enumerate(zip(listed, words_of([r["text"] for r in listed]), strict=True)) if len(w) >= n}
            codes = spark.sparkContext.broadcast(np.unique(np.concatenate([np.zeros(0, np.int64), *(ngrams(w, n) for w in texts.values())])))
            counted = rows.select(F.col("__text").alias("text")).mapInArrow(_counting(lambda c=codes: c.value, n), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
            counts = dict(counted.collect()) if texts else {}  # at most a row a seed
            chosen = {}
            for item, words in texts.items():
                grams = sorted({(counts.get(g, 0), g) for g in ngrams(words, n).tolist()})
                last = grams[min(len(grams), max(1, round(rare_share * len(grams)))) - 1][0]
                chosen[item] = {g for c, g in grams if c <= last}
            seeds = spark.sparkContext.broadcast(Seeds(texts, n, chosen))
            leaks = rows.mapInArrow(_searching(lambda s=seeds: s.value, least, schema), out)
            if blocks > 1:
                leaks = kept.stored(leaks, "leaks")
            found = leaks if found is None else found.unionByName(leaks)
        return stored(found, "all-leaks")
