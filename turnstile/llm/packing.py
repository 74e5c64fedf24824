"""Training sequences packed from lexically similar documents.

Documents are tokenised; what fills whole windows of a long document is cut off
first, its rest is packed with others. Rests are dealt into shards by lexical
keys, so that documents of like words meet. Each shard has a BM25 inverted index
over token ids, with statistics of the whole table; a seed document asks it for
unused neighbours, which fill the seed's window greedily, the last one cut to
fit. What is left of a cut document seeds the next window.
"""

import json
import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.shared import batch, parts, scratch, stored

#: Tokens of a shard's index: some hundred megabytes while it is built.
SHARD = 4 << 20
K1, B = 1.2, 0.75
#: Used documents leave the index once they are this share of the others.
_LEAVE = 0.25
#: Share of a shard's documents from which on a token is frequent; so there are no more
#: such tokens than a document's distinct ones times its inverse.
_FREQUENT = 0.2
# Fixed value: how a byte-level BPE of this family cuts a text before merging.
CUTS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones of
    Latin-1 stand for themselves, the others take the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [i for i in range(256) if i not in plain]
    return {chr(i): i for i in plain} | {chr(256 + k): i for k, i in enumerate(others)}


class Encoder:
    """Ids of texts by a byte-level BPE tokenizer file.

    The file's vocabulary is run by the faster of two public libraries; the ids
    are those of the file's own, which takes the texts that hold a special token.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken

        self._path, self._own = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._special = [t["content"] for t in spec["added_tokens"]]
        vocabulary = {t: i for t, i in spec["model"]["vocab"].items() if t not in self._special}
        self.size = len(vocabulary) + len(self._special)
        self.kind, self._code = ("<u2", "H") if self.size <= 1 << 16 else ("<u4", "I")
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
        self._fast = tiktoken.Encoding("file", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})

    def _exact(self, text: str) -> list[int]:
        """By the file's own library, which few texts need."""
        if self._own is None:
            from tokenizers import Tokenizer

            self._own = Tokenizer.from_file(self._path)
        return self._own.encode(text, add_special_tokens=False).ids

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            special = any(s in text for s in self._special)
            ids = self._exact(text) if special else self._fast.encode_ordinary(text)
            out.append(np.frombuffer(array(self._code, ids), self.kind))
        return out


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _spread(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    return (x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(1)


def lexical_keys(ids: np.ndarray) -> tuple[int, int]:
    """Smallest hashes of the ids and of the pairs of neighbouring ids: like texts agree."""
    one = _spread(ids).min()
    two = _spread(ids[:-1].astype(np.uint64) << np.uint64(32) | ids[1:]).min() if len(ids) > 1 else 0
    return int(one), int(two)


def _cutting(path: str, end: int, window: int, schema: pa.Schema) -> Callable:
    def run(batches):
        encode = _encoder(path)
        number = TaskContext.get().partitionId() << 40
        for b in parts(batches):
            texts = [t or "" for t in b.column("__text").to_pylist()]
            for k in range(0, len(texts), 256):
                at, rows = [], []
                for i, own in enumerate(encode(texts[k : k + 256])):
                    ids = np.append(own, np.array([end], own.dtype))
                    whole = len(ids) // window * window
                    for start in range(0, whole, window):
                        at.append(k + i)
                        rows.append((start, window, checksum(ids[start : start + window]), len(ids), number, None, 0, 0))
                        number += 1
                    if whole < len(ids):
                        rest = ids[whole:]
                        at.append(k + i)
                        rows.append((whole, len(rest), None, len(ids), number, rest.tobytes(), *lexical_keys(rest)))
                        number += 1
                take = pa.array(at, pa.int64())
                kept = [b.column(n).take(take) for n in schema.names[:-8]]
                yield batch(schema, *kept, *([r[c] for r in rows] for c in range(8)))

    return run


_FREQUENCY = pa.schema([("token", pa.int32()), ("n", pa.int64())])


def _frequencies(kind: str, size: int) -> Callable:
    def run(batches):
        counts = np.zeros(size, np.int64)
        for b in parts(batches):
            for ids in b.column("ids").to_pylist():
                counts[np.unique(np.frombuffer(ids, kind))] += 1
        used = np.flatnonzero(counts)
        yield batch(_FREQUENCY, used, counts[used])

    return run


class Index:
    """Inverted index of a shard: for each token, documents and BM25 weights."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, mean: float):
        self.docs = len(rests)
        counted = [np.unique(ids, return_counts=True) for ids in rests]
        self.terms = [t.astype(np.int32) for t, _ in counted]
        token = np.concatenate(self.terms)
        tf = np.concatenate([c for _, c in counted]).astype(np.float32)
        doc = np.repeat(np.arange(len(rests), dtype=np.int32), [len(t) for t in self.terms])
        length = np.array([len(r) for r in rests], np.float32)[doc]
        weight = idf[token].astype(np.float32) * tf * np.float32(K1 + 1) / (tf + np.float32(K1 * (1 - B)) + np.float32(K1 * B / mean) * length)
        # Tokens that much of the shard holds are columns of a table, whose product with
        # a seed's tokens takes far less time than their postings; the others have these.
        held, count = np.unique(token, return_counts=True)
        self._frequent = held[count >= max(2, self.docs * _FREQUENT)]
        column = np.minimum(np.searchsorted(self._frequent, token), max(0, len(self._frequent) - 1))
        often = self._frequent[column] == token if len(self._frequent) else np.zeros(len(token), bool)
        self._table = np.zeros((self.docs, len(self._frequent)), np.float32)
        self._table[doc[often], column[often]] = weight[often]
        token, doc, weight = token[~often], doc[~often], weight[~often]
        order = np.argsort(token, kind="stable")
        self._doc, self._weight, self._token = doc[order], weight[order], token[order]
        self._place()

    def _place(self) -> None:
        self._tokens, first = np.unique(self._token, return_index=True)
        self._first = np.append(first, len(self._token))

    def without(self, used: np.ndarray) -> None:
        """Leave out the postings of documents that no window can take any more."""
        left = ~used[self._doc]
        self._doc, self._weight, self._token = self._doc[left], self._weight[left], self._token[left]
        self._place()

    def neighbours(self, seed: int) -> np.ndarray:
        """BM25 score of every document for the seed's tokens."""
        own = self.terms[seed]
        score = self._table @ np.isin(self._frequent, own).astype(np.float32)
        if not len(self._tokens):
            return score.astype(float)
        row = np.minimum(np.searchsorted(self._tokens, own), len(self._tokens) - 1)
        row = row[self._tokens[row] == own]
        start, size = self._first[row], self._first[row + 1] - self._first[row]
        # The postings of all the seed's tokens in one gather.
        at = np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        return np.bincount(self._doc[at], self._weight[at], minlength=self.docs) + score


def best_first(score: np.ndarray, few: int = 32) -> Iterator[int]:
    """Places by falling score, equal ones in order; only as many as are asked for are sorted."""
    done = 0
    while done < len(score):
        if few < len(score):
            least = np.partition(score, len(score) - few)[len(score) - few]
            at = np.flatnonzero(score >= least)
        else:
            at = np.arange(len(score))
        at = at[np.argsort(-score[at], kind="stable")]
        yield from at[done:].tolist()
        done, few = len(at), 4 * few


class Packer:
    """Fills windows from shards that come one after the other."""

    def __init__(self, idf: np.ndarray, mean: float, window: int):
        self.idf, self.mean, self.window = idf, mean, window

    def shard(self, pieces: list[tuple], last: bool) -> tuple[list[list[tuple]], list[tuple]]:
        """Full windows of (key, start, ids), and what is left. Of the last shard
        the left pieces make one short window."""
        index = Index([ids for _, _, ids in pieces], self.idf, self.mean)
        key, start, left = [p[0] for p in pieces], [p[1] for p in pieces], [p[2] for p in pieces]
        unused, windows, taken = np.ones(len(pieces), bool), [], 0
        room = sum(len(ids) for ids in left)
        seed, next_seed = 0, None
        while room >= self.window:
            if next_seed is None:
                while not unused[seed]:
                    seed += 1
            now = seed if next_seed is None else next_seed
            score, next_seed, window, space = index.neighbours(now), None, [], self.window
            score[~unused] = -1
            score[now] = np.inf
            for i in best_first(score):
                ids = left[i][:space]
                window.append((key[i], start[i], ids))
                space -= len(ids)
                if len(ids) < len(left[i]):
                    start[i] += len(ids)
                    left[i] = left[i][len(ids) :]
                    next_seed = i
                else:
                    unused[i] = False
                    taken += 1
                if not space:
                    break
            windows.append(window)
            room -= self.window
            if taken > _LEAVE * unused.sum():
                index.without(~unused)
                taken = 0
        rest = [(key[i], start[i], left[i]) for i in np.flatnonzero(unused)]
        if last and rest:
            windows.append(rest)
            rest = []
        return windows, rest


def _packing(shared: Callable[[], tuple], kind: str, window: int, schema: pa.Schema) -> Callable:
    def run(batches):
        packer = Packer(*shared(), window)
        sequence, held, tokens, full = TaskContext.get().partitionId() << 40, [], 0, SHARD
        names = schema.names[:-6]

        def emit(windows):
            nonlocal sequence
            rows = []
            for pieces in windows:
                offset = 0
                for (row, tokens), start, ids in pieces:
                    rows.append((row, (start, len(ids), checksum(ids)), (tokens, 2 * sequence, offset)))
                    offset += len(ids)
                sequence += 1
            order = [[r[0][c] for r in rows] for c in range(len(names))]
            return batch(schema, *order, *([r[1][c] for r in rows] for c in range(3)), *([r[2][c] for r in rows] for c in range(3))) if rows else None

        def pieces(b):
            columns = [b.column(n).to_pylist() for n in (*names, "doc_tokens", "start", "ids")]
            for *own, tokens, start, ids in zip(*columns, strict=True):
                yield (tuple(own), tokens), start, np.frombuffer(ids, kind)

        for b in parts(batches):
            for piece in pieces(b):
                held.append(piece)
                tokens += len(piece[2])
                if tokens >= full:
                    windows, held = packer.shard(held, False)
                    tokens = sum(len(ids) for _, _, ids in held)
                    full = tokens + SHARD
                    if out := emit(windows):
                        yield out
        if held and (out := emit(packer.shard(held, True)[0])):
            yield out

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    keep: list[str],
    text: str = "text",
    window: int = 2048,
    end: int = 1,
) -> DataFrame:
    """A row for each piece of a document: the columns ``keep``, start, length,
    ids_crc32 (of little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset.

    A document is its text's ids and then ``end``; null and empty texts are
    ``end`` alone. Every id is in one piece. All sequences are full but the last
    of each task, of which there is one for some millions of tokens. Equal
    rows are packed each. Shards are dealt in lexical order; ties go by the place
    in the table. No rows: no rows. Other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    encoder = _encoder(tokenizer_path)
    kind, size = encoder.kind, encoder.size
    rows = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    base = rows.select(*keep)
    typed = lambda **c: {n: F.lit(None).cast(t) for n, t in c.items()}
    cut_type = base.withColumns(typed(start="long", length="long", ids_crc32="long", doc_tokens="long", number="long", ids="binary", key_one="long", key_two="long")).schema
    out_type = base.withColumns(typed(start="long", length="long", ids_crc32="long", doc_tokens="long", sequence_id="long", offset="long")).schema
    with scratch(spark) as kept:
        cut = kept.stored(rows.mapInArrow(_cutting(tokenizer_path, end, window, to_arrow_schema(cut_type)), cut_type), "cut")
        whole = cut.where("ids is null").select(*keep, "start", "length", "ids_crc32", "doc_tokens", (F.col("number") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
        rests = cut.where("ids is not null")
        totals = rests.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("tokens")).first()
        counts = rests.select("ids").mapInArrow(_frequencies(kind, size), "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
        df = np.zeros(size)
        for token, n in counts:
            df[token] = n
        idf = np.log1p((totals["n"] - df + 0.5) / (df + 0.5))
        shared = spark.sparkContext.broadcast((idf, max(1.0, totals["tokens"] / max(1, totals["n"]))))
        # As many tasks as the session asks for, but none of less than a shard.
        tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), totals["tokens"] // SHARD), totals["tokens"] // (64 << 20))
        order = ["key_one", "key_two", "number"]
        dealt = rests.select(*keep, "doc_tokens", "start", "ids", *order).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        packed = dealt.mapInArrow(_packing(lambda: shared.value, kind, window, to_arrow_schema(out_type)), out_type)
        return stored(whole.unionByName(packed), "packed")
