import time
from collections import Counter

import numpy as np
import pytest

from turnstile.llm import language
from turnstile.llm.queries import op9_language_mixture

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = op9_language_mixture(spark, FOLDER)
    held = got.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert got.count() == docs.count()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)


def test_shares_of_a_mixed_text_and_the_rest(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    long_ones = {lang: docs.where((docs.lang == lang) & (docs.n_chars > 3000)).orderBy("doc_id").first()["text"] for lang in ("en", "de")}
    mixed = long_ones["en"][:2000] + "\n" + long_ones["de"][:1000]
    rows = [(1, mixed, None), (2, None, "en"), (3, "", None), (4, "123 ?!", "de"), (None, long_ones["de"], None), (5, long_ones["de"], None), (5, long_ones["de"], None)]
    asked = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, lang string, lang_pred double")
    got = language.identify(asked, docs, ["doc_id"]).collect()
    assert len(got) == 7
    by = {r["doc_id"]: r for r in got}
    shares = {x["lang"]: x["share"] for x in by[1]["languages"]}
    assert set(shares) == {"en", "de"} and abs(shares["en"] - 2 / 3) < 0.1
    assert [by[k]["lang_pred"] for k in (2, 3, 4)] == ["und"] * 3 and by[None]["lang_pred"] == "de"
    assert all(by[k]["score"] == 0 for k in (2, 3, 4))


def test_nothing_to_learn_from_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in language.identify(docs, docs, ["doc_id"]).collect()] == ["und"]
    assert language.identify(docs.limit(0), docs, ["doc_id"]).count() == 0


def test_the_fit_is_that_of_a_grid_search():
    rng = np.random.default_rng(1)
    chances = rng.dirichlet(np.ones(language.CELLS) * 0.05, 2) + 1e-9
    fit = language.Mixture(["a", "b"], chances, 3.0, 200)
    cells = np.concatenate([rng.choice(language.CELLS, 300, p=chances[0] / chances[0].sum()), rng.choice(language.CELLS, 100, p=chances[1] / chances[1].sum())])
    cells, times = np.unique(cells, return_counts=True)
    p = fit.chances[cells]
    grid = np.linspace(0.001, 0.999, 999)
    best = grid[np.argmax([times @ np.log(p @ [g, 1 - g]) for g in grid])]
    assert abs(fit._shares(p, times)[0][0] - best) < 0.01


def test_a_small_share_of_a_long_text_is_a_language_of_it(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    words = {lang: " ".join(r["text"] for r in docs.where(docs.lang == lang).orderBy("doc_id").collect()).split() for lang in ("en", "de")}
    langs, chances = language.learn(docs, "text", "lang", "doc_id", 20_000)
    fit = language.Mixture(langs, chances, 3.0, 12).fit
    mixed, alone = dict(fit(" ".join(words["en"][:19_800] + words["de"][:200]))), dict(fit(" ".join(words["en"][:20_000])))
    assert set(mixed) - set(alone) == {"de"} and abs(mixed["de"] - 0.01) < 0.005
    assert all(share > 0 for share in alone.values()) and max(alone, key=alone.get) == "en"


def plain_trigrams(text):
    """Hashes of trigrams one by one, with counts."""
    runs = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    if not runs.strip():
        return {}
    # Only the first of a run of other characters counts.
    kept = "".join(c for i, c in enumerate(runs) if c != " " or i == 0 or runs[i - 1] != " ")
    found, mask = Counter(), (1 << 64) - 1
    for a, b, c in zip(f" {kept} ", f" {kept} "[1:], f" {kept} "[2:]):
        mixed = ((ord(a) * 0x9E3779B1 + ord(b)) * 0x85EBCA77 + ord(c)) & mask
        found[((mixed * 0xC2B2AE3D27D4EB4F) & mask) >> 48] += 1
    return dict(found)


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1 << 18])
@pytest.mark.parametrize("text", ["", None, "a", "  a", "a  ", "ab1cd", "Über 12 Straßen!", "--", "日本語 text", "x" * 20, " a b  c   d "])
def test_trigrams_do_not_depend_on_the_blocks(monkeypatch, text, block):
    monkeypatch.setattr(language, "_BLOCK", block)
    cells, counts = language.trigrams(text)
    assert dict(zip(cells.tolist(), counts.tolist(), strict=True)) == plain_trigrams(text)


def test_a_text_of_millions_of_characters_takes_little_time():
    rng = np.random.default_rng(3)
    langs = [f"l{i:02}" for i in range(30)]
    fit = language.Mixture(langs, rng.dirichlet(np.ones(language.CELLS), 30) + 1e-9, 3.0, 12).fit
    words = ["".join(chr(97 + k) for k in rng.integers(0, 26, 6)) for _ in range(50_000)]
    text = " ".join(words[k] for k in rng.integers(0, len(words), 1_200_000))
    start = time.time()
    assert fit(text) and len(text) > 8_000_000
    assert time.time() - start < 40
