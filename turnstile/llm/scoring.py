"""Document likelihood under a unigram subword model, all segmentations summed.

A text is a sequence of words and one end. A word is drawn whole, by its
training frequency, or spelled by pieces of an existing subword vocabulary and a
stop. Its probability is the sum over all paths of that lattice, computed by a
forward recursion in log space. The pieces' scores start from the vocabulary's
order and are re-estimated on the training words by expectation-maximisation;
the weight of spelling is that of greatest leave-one-out likelihood.
"""

import base64
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain
from math import exp, inf, log, log1p, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.shared import batch, parts, raw, scratch, stored

#: Stands for the end of a text; no word holds white space.
END = b"\n"
#: Bytes that fit one integer. Longer pieces are looked up by a hash and then compared.
WIDTH = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Distinct words that a task holds before it hands its counts on, and bytes of texts.
HELD, HELD_BYTES = 400_000, 64 << 20
#: Bytes from which on a word is taken one by one, in a window.
LONG = 1_024

_COUNTS = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("used", pa.int64())])
_EXPECTED = pa.schema([("piece", pa.int32()), ("weight", pa.float64())])
_SPELLED = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("used", pa.int64()), ("spelled", pa.float64())])


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a rank file (base64 and rank a line), by rank: no white space,
    every single byte present."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(piece)) for piece, rank in map(bytes.split, lines))
    pieces = (piece.strip() for _, piece in ranked)
    one = (bytes([i]) for i in range(256) if not bytes([i]).isspace())
    return list(dict.fromkeys(p for p in chain(pieces, one) if p and len(p.split()) == 1))


class Lattice:
    """Pieces with natural-log scores, and the recursions over them."""

    def __init__(self, pieces: list[bytes], scores: np.ndarray, stop: float):
        self.scores, self.stop, self._pieces, self._spelt = scores, stop, pieces, None
        self.tables, by_length = {}, {}
        for i, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(i)
        self.lengths = sorted(by_length)
        for n, own in by_length.items():
            at = np.array(own, np.int64)
            spelt = np.frombuffer(b"".join(pieces[i] for i in own), np.uint8).reshape(len(own), n).astype(np.uint64)
            codes = np.zeros(len(own), np.uint64)
            for k in range(n):
                codes = self._longer(codes, spelt[:, k], k + 1)
            order = np.argsort(codes)
            self.tables[n] = codes[order], at[order], spelt[order]

    @staticmethod
    def _longer(code: np.ndarray, byte: np.ndarray, n: int) -> np.ndarray:
        """Codes of n bytes from those of n-1 and the last byte: exact up to ``WIDTH``, then a rolling hash."""
        return (code << np.uint64(8)) | byte if n <= WIDTH else code * _BASE + byte

    def _found(self, words: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """(end, length) -> rows of ``words`` that hold a piece there, and the pieces."""
        found, width = {}, words.shape[1]
        code = np.zeros(words.shape, np.uint64)  # of the n bytes up to each place
        for n in range(1, min(self.lengths[-1], width) + 1):
            # Code of the n bytes that start at i: one more byte on those of n-1.
            code = self._longer(code[:, : width - n + 1], words[:, n - 1 :], n)
            if n not in self.tables:
                continue
            codes, at, spelt = self.tables[n]
            place = np.searchsorted(codes, code.ravel()).reshape(code.shape)
            place[place == len(codes)] = 0
            hit = codes[place] == code
            for i in np.flatnonzero(hit.any(axis=0)):
                rows = np.flatnonzero(hit[:, i])
                if n > WIDTH:
                    rows = rows[(words[rows, i : i + n] == spelt[place[rows, i]]).all(axis=1)]
                if len(rows):
                    found[i + n, n] = rows, at[place[rows, i]]
        return found

    def _forward(self, words: np.ndarray, found: dict) -> np.ndarray:
        alpha = np.full((words.shape[1] + 1, len(words)), -np.inf)
        alpha[0] = 0
        for end in range(1, words.shape[1] + 1):
            here = alpha[end]
            for n in self.lengths:
                if (end, n) in found:
                    rows, pieces = found[end, n]
                    here[rows] = np.logaddexp(here[rows], alpha[end - n, rows] + self.scores[pieces])
        return alpha

    def spelled(self, words: np.ndarray) -> np.ndarray:
        """Natural-log probability of each of the equally long words."""
        return self._forward(words, self._found(words))[-1] + self.stop

    def spelled_long(self, word: bytes) -> float:
        """The same of one word of any length, over a window of the longest piece: the
        room does not grow with the word, the time in proportion."""
        if self._spelt is None:
            begun = {p[:k] for p in self._pieces for k in range(1, len(p) + 1)}
            self._spelt = dict(zip(self._pieces, self.scores.tolist(), strict=True)), begun
        score, begun = self._spelt
        none, size = -inf, self.lengths[-1] + 1
        window = [none] * size
        window[0] = 0.0
        for start in range(len(word)):
            here, window[start % size] = window[start % size], none
            if here == none:
                continue
            end = start + 1
            while end <= len(word) and (piece := word[start:end]) in begun:
                step = score.get(piece)
                if step is not None:
                    old, new = window[end % size], here + step
                    if old == none:
                        window[end % size] = new
                    else:
                        window[end % size] = max(old, new) + log1p(exp(-abs(old - new)))
                end += 1
        return window[len(word) % size] + self.stop

    def expect(self, words: np.ndarray, into: np.ndarray, times: np.ndarray | None = None) -> None:
        """Add the expected uses of each piece over all segmentations, each word
        as many ``times`` as it is used, or once."""
        times = np.ones(len(words)) if times is None else times
        found = self._found(words)
        alpha = self._forward(words, found)
        width, whole = words.shape[1], alpha[-1]
        beta = np.full(alpha.shape, -np.inf)
        beta[width] = 0
        for start in range(width - 1, -1, -1):
            here = beta[start]
            for n in self.lengths:
                if (start + n, n) in found:
                    rows, pieces = found[start + n, n]
                    step = self.scores[pieces] + beta[start + n, rows]
                    here[rows] = np.logaddexp(here[rows], step)
                    np.add.at(into, pieces, times[rows] * np.exp(alpha[start, rows] + step - whole[rows]))


def _by_length(words: list[bytes]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Positions of equally long words, and their bytes as rows."""
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        groups.setdefault(len(word), []).append(i)
    for width, at in groups.items():
        block = max(1, 2_000_000 // (width * WIDTH))
        for k in range(0, len(at), block):
            part = at[k : k + block]
            yield part, np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(len(part), width).astype(np.uint64)


def _tokens(text: bytes | None) -> list[bytes]:
    # Bytes: lower() changes A-Z only, split() cuts at 0x20 and 0x09-0x0D.
    return [*(text or b"").lower().split(), END]


def _counting(batches):
    learned, other = Counter(), Counter()

    def flush():
        words = list(learned.keys() | other.keys())
        out = batch(_COUNTS, words, [learned[w] for w in words], [learned[w] + other[w] for w in words])
        learned.clear()
        other.clear()
        return out

    size = 0
    for b in parts(batches):
        for text, held in zip(raw(b.column("text")), b.column("held_out").to_pylist(), strict=True):
            (other if held else learned).update(_tokens(text))
            size += len(text or b"")
            if len(learned) + len(other) > HELD or size > HELD_BYTES:
                yield flush()
                size = 0
    yield flush()


def _expecting(pieces: list[bytes], model: Callable[[], tuple[np.ndarray, float]]) -> Callable:
    def run(batches):
        lattice, into = Lattice(pieces, *model()), np.zeros(len(pieces))
        for b in batches:
            words, times = b.column("word").to_pylist(), b.column("c").to_numpy(zero_copy_only=False).astype(float)
            # A long word is learned from stretch by stretch.
            cut = [(w[k : k + LONG], t) for w, t in zip(words, times.tolist(), strict=True) for k in range(0, len(w), LONG)]
            times = np.array([t for _, t in cut])
            for at, rows in _by_length([w for w, _ in cut]):
                lattice.expect(rows, into, times[at])
        used = np.flatnonzero(into)
        yield batch(_EXPECTED, used, into[used])

    return run


def _spelling(pieces: list[bytes], model: Callable[[], tuple[np.ndarray, float]]) -> Callable:
    def run(batches):
        lattice = Lattice(pieces, *model())
        for b in batches:
            words = b.column("word").to_pylist()
            out = np.full(len(words), -np.inf)
            short = [i for i, w in enumerate(words) if len(w) <= LONG]
            for at, rows in _by_length([words[i] for i in short]):
                out[[short[i] for i in at]] = lattice.spelled(rows)
            for i, word in enumerate(words):
                if len(word) > LONG:
                    out[i] = lattice.spelled_long(word)
            yield batch(_SPELLED, words, b.column("c"), b.column("used"), out)

    return run


def _prior(seen: DataFrame, n: int) -> float:
    """How many training tokens the spelled path is worth: of a row of values the
    one that makes the words, each left out once, most likely."""
    if not n:
        return 1.0
    sizes = [n * 2.0**k for k in range(-8, 5)]
    left_out = [
        F.sum(F.col("c") * F.log((F.col("c") - 1 + F.lit(size) * F.exp(F.greatest("spelled", F.lit(-700.0)))) / F.lit(n - 1 + size))) for size in sizes
    ]
    found = seen.agg(*(f.alias(f"s{k}") for k, f in enumerate(left_out))).first()
    fits = [-float("inf") if f is None else f for f in found]
    return sizes[fits.index(max(fits))]


def score_documents(
    docs: DataFrame,
    vocabulary_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    held_out: str = "held_out",
    rounds: int = 3,
    common: int = 400_000,
) -> DataFrame:
    """Score whole texts; learn from the rows where ``held_out`` is not true.

    ``rounds``: passes of expectation-maximisation. ``common``: words that make
    up one in so many of all uses are sent to every task, so there are at most
    that many; all others meet their scores in a join, and no key of it is hot.

    Rows: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigram), score (log10 probability). Null and empty texts are the end alone.
    A null id is a row like others; equal rows are scored alike and all returned.
    With no rows to learn from every word is spelled. No rows: no rows. A word may be as
    long as a text: from ``LONG`` bytes on it is scored in a window, exactly, and the
    pieces' scores are learned from its stretches of so many bytes.
    Other columns are not read.
    """
    spark = docs.sparkSession
    own = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(held_out), F.lit(False)).alias("held_out"),
    )
    with scratch(spark) as kept:
        counts = kept.stored(
            own.select("text", "held_out")
            .mapInArrow(_counting, "word binary, c long, used long")
            .groupBy("word")
            .agg(F.sum("c").alias("c"), F.sum("used").alias("used")),
            "word-counts",
        )
        seen, words = F.col("c") > 0, F.col("word") != F.lit(bytearray(END))
        total = counts.agg(
            F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
            F.count_if(seen).alias("v"),
            F.coalesce(F.sum(F.when(words, F.col("c"))), F.lit(0)).alias("words"),
        ).first()
        pieces = vocabulary(vocabulary_path)
        prior = 1 / np.arange(1, len(pieces) + 1)
        scores, stop = np.log(prior / prior.sum() * 0.75), log(0.25)
        types = counts.where(seen & words)
        for _ in range(rounds):
            model = spark.sparkContext.broadcast((scores, stop))
            expected = np.full(len(pieces), 1e-3)
            # At most one row a piece of the vocabulary comes back.
            for row in (
                types.select("word", "c")
                .mapInArrow(_expecting(pieces, lambda m=model: m.value), "piece int, weight double")
                .groupBy("piece")
                .agg(F.sum("weight").alias("weight"))
                .collect()
            ):
                expected[row["piece"]] += row["weight"]
            ends = total["words"] + 1
            whole = expected.sum() + ends
            scores, stop = np.log(expected / whole), log(ends / whole)
        model = spark.sparkContext.broadcast((scores, stop))
        n, v = total["n"], total["v"]
        spelled = kept.stored(counts.mapInArrow(_spelling(pieces, lambda m=model: m.value), "word binary, c long, used long, spelled double"), "word-spellings")
        prior = _prior(spelled.where(seen & words), n)
        whole = F.col("c") / F.lit(n + prior)
        by_pieces = F.col("spelled") + F.lit(log(prior / (n + prior)))
        both = whole + F.when(words, F.exp(by_pieces)).otherwise(F.lit(0.0))
        # Past the range of a double only a long unseen word is left.
        scored = kept.stored(
            spelled.select(
                "word", "c", "used",
                F.when(both > 0, F.log10(both)).when(words, by_pieces / F.lit(log(10))).otherwise(F.lit(-300.0)).alias("lp"),
            ),
            "word-scores",
        )
        # Of all uses at most ``common`` words can each have that share: a bound
        # on what is sent, and no sort.
        uses = counts.agg(F.coalesce(F.sum("used"), F.lit(0))).first()[0]
        top = scored.where(F.col("used") * common >= uses).collect()
        usual = spark.sparkContext.broadcast({bytes(r["word"]): (r["c"] > 0, log10((r["c"] + 1) / (n + v + 1)), r["lp"]) for r in top})

        def summing(batches):
            schema = pa.schema([("doc_id", id_type), ("mark", pa.int64()), ("held_out", pa.bool_()), ("copies", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
            known = usual.value
            for b in parts(batches):
                rows = [], [], [], []
                for text in raw(b.column("text")):
                    tokens = _tokens(text)
                    hits = [known[t] for t in tokens if t in known]
                    rows[0].append(len(tokens))
                    rows[1].append(sum(h[0] for h in hits))
                    rows[2].append(sum(h[1] for h in hits))
                    rows[3].append(sum(h[2] for h in hits))
                yield batch(schema, b.column("doc_id"), b.column("mark"), b.column("held_out"), [1] * b.num_rows, *rows)

        def rare(batches):
            schema = pa.schema([("doc_id", id_type), ("mark", pa.int64()), ("held_out", pa.bool_()), ("word", pa.binary()), ("n", pa.int64())])
            known = usual.value
            for b in parts(batches):
                at, words, ns = [], [], []
                for i, text in enumerate(raw(b.column("text"))):
                    for word, k in Counter(t for t in _tokens(text) if t not in known).items():
                        at.append(i)
                        words.append(word)
                        ns.append(k)
                at = pa.array(at, pa.int64())
                yield batch(schema, *(b.column(c).take(at) for c in ("doc_id", "mark", "held_out")), words, ns)

        kind = own.schema["doc_id"].dataType
        from pyspark.sql.pandas.types import to_arrow_type

        id_type = to_arrow_type(kind)
        # Equal rows add up under one key and are told apart again by their number.
        marked = own.withColumn("mark", F.xxhash64("text"))
        head = f"doc_id {kind.simpleString()}, mark long, held_out boolean"
        sums = marked.mapInArrow(summing, f"{head}, copies long, n_tokens long, n_known long, base_score double, score double")
        base = F.log10((F.col("c") + 1) / F.lit(float(n + v + 1)))
        others = (
            marked.mapInArrow(rare, f"{head}, word binary, n long")
            .join(scored.select("word", "c", "lp"), "word")
            .select(
                "doc_id", "mark", "held_out", F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_tokens"),
                F.when(seen, F.col("n")).otherwise(F.lit(0)).cast("long").alias("n_known"),
                (F.col("n") * base).alias("base_score"), (F.col("n") * F.col("lp")).alias("score"),
            )
        )
        names = ["copies", "n_tokens", "n_known", "base_score", "score"]
        merged = sums.unionByName(others).groupBy("doc_id", "mark", "held_out").agg(*(F.sum(c).alias(c) for c in names))
        share = lambda c: (F.col(c) / F.col("copies")).cast(merged.schema[c].dataType).alias(c)
        return stored(
            merged.select(
                "doc_id", "held_out", share("n_tokens"), share("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
                share("base_score"), share("score"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
            ).drop("copy"),
            "scores",
        )
