import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from turnstile.llm import packing
from turnstile.llm.queries import op3_retrieval_packing, tokenizer

PATH = tokenizer("byte_bpe_50k.json")


def reference_ids(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def assert_whole(rows, texts):
    """Every id once, sequences gapless; texts: ids by a row's key."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert pieces.keys() == texts.keys()
    for key, own in pieces.items():
        ids = texts[key]
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    return sequences


def test_every_id_of_the_small_table_is_packed_once(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: reference_ids(r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sequences = assert_whole(op3_retrieval_packing(spark, folder).collect(), texts)
    total = sum(map(len, texts.values()))
    assert total / (2048 * len(sequences)) > 0.98


@pytest.mark.parametrize(
    "text",
    ["", " ", "a", " a  b\n c ", "tab\t x", "don't  you'll", "end. \n\nNext", "x" * 5000, "<|endoftext|> and <|endoftext|>", "é ü 漢字 🙂", "a b c d", "\r\n \r\n"],
)
def test_ids_are_the_tokenizer_files(text):
    assert packing._encoder(PATH)([text, text + " more"])[0].tolist() == reference_ids(text)[:-1]


def test_nulls_repeats_and_no_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 6000), (None, "no id"), (4, "twin text")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, offset int")
    got = packing.pack(docs, PATH, ["doc_id"]).collect()
    assert_whole(got, {i: reference_ids(t) for i, t in rows})
    twins = spark.createDataFrame([(4, "twin text")] * 3, "doc_id long, text string")
    assert sum(r["length"] for r in packing.pack(twins, PATH, ["doc_id"]).collect()) == 3 * len(reference_ids("twin text"))
    assert packing.pack(docs.limit(0), PATH, ["doc_id"]).count() == 0


def test_index_scores_are_bm25():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 30, rng.integers(1, 40)).astype("<u2") for _ in range(25)]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=30)
    idf = np.log1p((25 - df + 0.5) / (df + 0.5))
    mean = np.mean([len(d) for d in docs])
    index = packing.Index(docs, idf, mean)
    for q in (0, 7, 24):
        for d, doc in enumerate(docs):
            expect = sum(
                idf[t] * (tf := (doc == t).sum()) * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(doc) / mean)) for t in np.unique(docs[q])
            )
            assert index.neighbours(q)[d] == pytest.approx(expect)


def test_a_window_is_filled_by_the_seeds_neighbours():
    topics = [np.arange(k * 100, k * 100 + 50).astype("<u2") for k in range(4)]
    docs = [((k, 50), 0, topics[k % 4]) for k in range(16)]
    packer = packing.Packer(np.ones(1000), 50.0, 200)
    windows, rest = packer.shard(docs, True)
    assert len(windows) == 4 and not rest
    assert [{key % 4 for (key, _), _, _ in w} for w in windows] == [{0}, {1}, {2}, {3}]


def test_like_documents_far_apart_in_lexical_order_meet(spark):
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    word = lambda: "".join(rng.choice(letters, 7))
    docs = []
    for pair in range(700):
        shared = [word() for _ in range(6)]
        # Words of their own give the two other keys.
        docs += [(2 * pair + k, " ".join([*(word() for _ in range(12)), *shared])) for k in (0, 1)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH, ["doc_id"], window=128).collect()
    held = defaultdict(set)
    for r in rows:
        held[r["doc_id"]].add(r["sequence_id"])
    assert sum(bool(held[2 * p] & held[2 * p + 1]) for p in range(700)) > 0.5 * 700
