import zlib

import numpy as np
import pytest

from turnstile.llm import toxicity
from turnstile.llm.queries import op2_toxicity

FOLDER = "/root/testdata/sf0.01"


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    for s in set(scores):
        ranks[scores == s] = ranks[scores == s].mean()
    pos = labels == 1
    return (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_rows_are_ranked_well(spark):
    got = op2_toxicity(spark, FOLDER)
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [(r["score"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    assert auc(np.array([s for s, _ in held]), np.array([t for _, t in held])) > 0.8


def test_features():
    traits = toxicity.Traits({"idiot": 3.0, "scum^": 2.0})
    table = traits.table(["You idiot!", "1d10t scumbag", "FINE day", None, ""])
    at = toxicity.FEATURES.index
    assert table[0, at("word_hits")] == 1 and table[0, at("near_second_person")] == 0.5 and table[0, at("exclamations")] == 0.5
    assert table[1, at("hidden_hits")] == 1 and table[1, at("prefix_hits")] == 1 and table[1, at("digits_inside")] == 0.5
    assert table[2, at("capital_words")] == 0.5 and not table[2, at("word_hits")]
    assert not table[3:].any()
    assert toxicity.revealed("st*p!d") == "stpid" and toxicity.revealed("looooser") == "loser" and toxicity.plain("(Ümlaut)...") == "ümlaut"


def test_a_small_cache_changes_nothing(monkeypatch):
    texts = [f"word{k} you idiot {'x' * k}" for k in range(50)]
    whole = toxicity.Traits({"idiot": 3.0}).table(texts)
    monkeypatch.setattr(toxicity, "_REMEMBERED", 5)
    assert (toxicity.Traits({"idiot": 3.0}).table(texts) == whole).all()


@pytest.mark.parametrize(("labels", "share"), [([1, 1], 1.0), ([0, 0], 0.0), ([], 0.0), ([None], 0.0)])
def test_labels_of_one_kind(spark, labels, share):
    docs = spark.createDataFrame([(0, "a text", 5), (1, None, 5)], "doc_id long, text string, score int")
    known = spark.createDataFrame([(k, v) for k, v in enumerate(labels)], "doc_id long, toxic int")
    assert {(r["score"], r["predicted"]) for r in toxicity.score_toxicity(docs, known, ["doc_id"]).collect()} == {(share, int(share))}


def test_toxic_texts_score_high_and_odd_rows_have_scores(spark):
    rows = [(k, f"calm words number {'abcdefghij'[k % 10]} {'qrstuvwxyz'[k // 10 % 10]}" + (" you are a worthless moron" if k % 4 == 0 else " and all is well today"), int(k % 4 == 0)) for k in range(200)]
    odd = [(1001, "well now you are a worthless moron"), (1002, "calm words"), (1003, None), (None, ""), (1002, "calm words")]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + odd, "doc_id long, text string")
    known = spark.createDataFrame([(i, v) for i, _, v in rows] + [(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, known, ["doc_id"]).collect()
    assert len(got) == 205
    by = {r["doc_id"]: r for r in got}
    assert by[1001]["predicted"] == 1 and by[1002]["predicted"] == 0 and by[1003]["predicted"] == 0 and by[1001]["score"] > by[1002]["score"]
