import random

import numpy as np
import pytest

from turnstile.llm import leaks
from turnstile.llm.queries import op8_benchmark_leaks


def smith_waterman(item, text):
    best = 0
    score = [0] * (len(text) + 1)
    for w in item:
        new = [0]
        for j, t in enumerate(text):
            new.append(max(0, score[j] + (leaks.MATCH if w == t else leaks.MISMATCH), score[j + 1] + leaks.GAP, new[j] + leaks.GAP))
        score = new
        best = max(best, *score)
    return best


def test_alignment_is_that_of_the_full_table():
    rng = random.Random(4)
    for _ in range(200):
        item = [rng.randrange(5) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(5) for _ in range(rng.randrange(1, 25))]
        score, first, past = leaks.align(np.array(item), np.array(text))
        assert score == smith_waterman(item, text)
        # The stretch alone gives the same score.
        assert not score or smith_waterman(item, text[first:past]) == score


def test_finds_what_a_full_search_finds_on_the_small_table(spark):
    folder = "/root/testdata/sf0.001"
    words = lambda text: leaks.words_of([text])[0]
    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    expect = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").where("n_chars < 6000").collect():
        text = words(r["text"])
        expect |= {(r["doc_id"], i) for i, w in items.items() if len(text) and leaks.align(w, text)[0] >= leaks.MATCH * len(w) * 0.5}
    got = {(r["doc_id"], r["item_id"]) for r in op8_benchmark_leaks(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").where("n_chars < 6000").select("doc_id"), "doc_id").collect()}
    assert got == expect and got


def passage(k, n=40):
    rng = random.Random(k)
    return [f"p{rng.randrange(10**5)}" for _ in range(n)]


@pytest.mark.parametrize("block", [20_000, 3])
def test_copies_edited_copies_and_bystanders(spark, block):
    rng = random.Random(9)
    filler = lambda n: [f"f{rng.randrange(10**5)}" for _ in range(n)]
    items = spark.createDataFrame([(k, " ".join(passage(k))) for k in range(8)] + [(90, None), (91, "two words"), (92, " ".join(passage(3)))], "item_id long, text string")
    edited, cut = passage(1), passage(2)
    for at in (3, 9, 16, 22, 30, 36):
        edited[at] = "other"
    del cut[5], cut[20]
    cut[10:10] = ["new", "words"]
    docs = [
        (1, filler(100) + passage(0) + filler(100)),
        (2, filler(10) + edited),
        (3, cut + filler(50)),
        (4, [w.upper() + "," for w in passage(3)]),
        (5, filler(300)),
        (6, passage(4)[:12] + filler(100)),  # too little of it
        (7, passage(5) + filler(5) + passage(5)),
    ]
    df = spark.createDataFrame([(i, " ".join(t), 1.0) for i, t in docs] + [(8, None, 1.0), (9, "", 1.0), (None, " ".join(passage(6)), 1.0)], "doc_id long, text string, score double")
    got = {(r["doc_id"], r["item_id"]): r for r in leaks.find_leaks(df, items, ["doc_id"], block=block).collect()}
    assert set(got) == {(1, 0), (2, 1), (3, 2), (4, 3), (4, 92), (7, 5), (None, 6)}
    assert got[1, 0]["score"] == 1 and (got[1, 0]["first_word"], got[1, 0]["past_word"]) == (100, 140)
    assert 0.5 < got[2, 1]["score"] < 0.9


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert leaks.find_leaks(docs, items.limit(0), ["doc_id"]).count() == 0
    assert leaks.find_leaks(docs.limit(0), items, ["doc_id"]).count() == 0
    assert leaks.find_leaks(docs, items, ["doc_id"]).count() == 1


@pytest.mark.parametrize("size", [1 << 24, 100])
def test_an_item_of_several_texts_and_a_long_document(spark, monkeypatch, size):
    """Blocks by bytes; a text of megabytes is searched to its end."""
    monkeypatch.setattr(leaks, "BLOCK_BYTES", size)
    items = spark.createDataFrame([(7, " ".join(passage(1))), (7, " ".join(passage(2))), (8, " ".join(passage(3)))], "item_id long, text string")
    long = " ".join(f"w{k}" for k in range(500_000)) + " " + " ".join(passage(2))
    docs = spark.createDataFrame([(1, " ".join(passage(1) + passage(2)[:25])), (2, long), (3, "x" * 3_000_000)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["score"], r["first_word"]) for r in leaks.find_leaks(docs, items, ["doc_id"]).collect())
    assert got == [(1, 7, 1.0, 0), (2, 7, 1.0, 500_000)]
