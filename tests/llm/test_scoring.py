import math
import time
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from turnstile.llm import scoring
from turnstile.llm.queries import tokenizer

RANKS = tokenizer("byte_bpe_50k.tiktoken")


def test_lattice_sums_all_segmentations():
    pieces = [b"a", b"b", b"ab", b"ba", b"aba"]
    chance = {p: c for p, c in zip(pieces, (0.2, 0.15, 0.1, 0.2, 0.05), strict=True)}
    lattice = scoring.Lattice(pieces, np.log(list(chance.values())), math.log(0.3))
    for word in (b"a", b"abab", b"bbaab", b"ababab"):
        total = 0.0
        for cuts in product((0, 1), repeat=len(word) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
            total += math.prod(chance.get(word[x:y], 0) for x, y in zip(at, at[1:], strict=False))
        rows = np.array([list(word)], np.uint64)
        assert lattice.spelled(rows)[0] == pytest.approx(math.log(total * 0.3))


def test_expected_uses_are_those_of_all_paths():
    pieces = [b"a", b"aa"]
    lattice = scoring.Lattice(pieces, np.log([0.5, 0.25]), math.log(0.25))
    into = np.zeros(2)
    lattice.expect(np.array([list(b"aa")], np.uint64), into)
    # a+a has 0.25, aa has 0.25: either half of the time.
    assert into == pytest.approx([1.0, 0.5])


def test_very_long_words_do_not_underflow():
    lattice = scoring.Lattice([b"x"], np.array([math.log(0.01)]), math.log(0.5))
    assert lattice.spelled(np.full((1, 3000), ord("x"), np.uint64))[0] == pytest.approx(3000 * math.log(0.01) + math.log(0.5))


def test_scores_follow_the_counts(spark):
    texts = [(1, "The cat the\tdog"), (2, None), (3, ""), (4, "cat zzyzx cat"), (4, "cat zzyzx cat"), (None, "the ÉTÉ")]
    docs = spark.createDataFrame(
        [(i, t, i == 4, 0.5) for i, t in texts], "doc_id long, text string, held_out boolean, score double"
    )
    found = scoring.score_documents(docs, RANKS).collect()
    assert len(found) == 6
    tokens = lambda t: [w.lower() for w in (t or "").replace("\t", " ").split(" ") if w]
    counts = Counter(w for i, t in texts if i != 4 for w in [*tokens(t), "\n"])
    n, v = sum(counts.values()), len(counts)
    for row in found:
        text = dict(texts)[row["doc_id"]]
        own = [*(w if w != "été" else "ÉtÉ".lower() for w in tokens(text)), "\n"]
        own = ["ÉtÉ" if w == "été" and "ÉTÉ" in (text or "") else w for w in own]
        assert row["n_tokens"] == len(own) and row["train_tokens"] == n
        assert row["held_out"] == (row["doc_id"] == 4)
        if row["doc_id"] is not None:
            assert row["n_known"] == sum(w in counts for w in own)
            assert row["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
        assert -300 < row["score"] < 0


def test_more_likely_texts_score_higher_and_chances_sum_to_one(spark):
    docs = spark.createDataFrame([(i, "red blue red green", False) for i in range(20)] + [(99, "red", True), (98, "qqq", True)], "doc_id long, text string, held_out boolean")
    found = {r["doc_id"]: r["score"] for r in scoring.score_documents(docs, RANKS).collect()}
    assert found[99] > found[98]
    assert 10 ** found[99] + 10 ** found[98] < 1


def test_no_rows_and_no_rows_to_learn_from(spark):
    schema = "doc_id long, text string, held_out boolean"
    assert scoring.score_documents(spark.createDataFrame([], schema), RANKS).count() == 0
    row = scoring.score_documents(spark.createDataFrame([(1, "a word", True)], schema), RANKS).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and math.isfinite(row["score"])


def test_held_out_texts_beat_a_uniform_spelling(spark):
    from turnstile.llm.queries import op1_lm_scoring

    rows = op1_lm_scoring(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in rows)
    spelled = sum(len(docs[r["doc_id"]].encode()) for r in rows if r["held_out"]) * -math.log10(30)
    assert sum(r["score"] for r in rows if r["held_out"]) > spelled


def test_pieces_of_all_lengths_take_part():
    pieces = scoring.vocabulary(RANKS)
    assert max(map(len, pieces)) > 100 and sum(len(p) > 8 for p in pieces) > 5000
    pieces = [b"a", b"b", b"abababababab", b"bababababa", b"b" * 9]
    chance = dict(zip(pieces, (0.2, 0.15, 0.1, 0.2, 0.05), strict=True))
    lattice = scoring.Lattice(pieces, np.log(list(chance.values())), math.log(0.3))
    for word in (b"abababababab", b"bababababababa", b"a" + b"b" * 11, b"ababababbbab"):
        alpha = [1.0]
        for end in range(1, len(word) + 1):
            alpha.append(sum(alpha[end - len(p)] * c for p, c in chance.items() if word[:end].endswith(p)))
        assert lattice.spelled(np.array([list(word)], np.uint64))[0] == pytest.approx(math.log(alpha[-1] * 0.3))


def test_expected_uses_count_a_word_as_often_as_it_is_used():
    into = np.zeros(2)
    scoring.Lattice([b"a", b"b"], np.log([0.5, 0.25]), math.log(0.25)).expect(np.array([list(b"ab"), list(b"bb")], np.uint64), into, np.array([3.0, 1.0]))
    assert into == pytest.approx([3.0, 5.0])


def test_a_word_in_a_window_scores_as_in_a_table():
    rng = np.random.default_rng(7)
    pieces = [b"a", b"b", b"c", b"ab", b"bca", b"aaaa", b"cabcabcab", b"abcabcabcabca"]
    lattice = scoring.Lattice(pieces, np.log(rng.dirichlet(np.ones(len(pieces)))), math.log(0.2))
    for n in (1, 2, 13, 14, 300):
        word = bytes(rng.choice(list(b"abc"), n).tolist())
        assert lattice.spelled_long(word) == pytest.approx(lattice.spelled(np.array([list(word)], np.uint64))[0])
    assert lattice.spelled_long(b"axb") == -math.inf


def test_a_word_of_megabytes(spark, monkeypatch):
    """Time in proportion, whole documents scored; the score is that of a smaller bound's table."""
    long = "".join(chr(97 + k % 23) for k in range(2_000_000))
    docs = [(1, "red blue red", False), (2, "x" * 3_000 + " red", False), (3, long, True), (4, "日本" * 200_000, False)]
    df = spark.createDataFrame(docs, "doc_id long, text string, held_out boolean")
    start = time.time()
    got = {r["doc_id"]: r for r in scoring.score_documents(df, RANKS).collect()}
    assert time.time() - start < 90
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got.values())
    assert got[3]["score"] < got[1]["score"] and got[3]["n_tokens"] == 2 and got[2]["n_tokens"] == 3


def brute_force(docs, spelled, prior):
    """Log10 probability of whole documents from the words' own chances, in plain Python."""
    counts = Counter(t for _, text, held in docs if not held for t in scoring._tokens((text or "").encode()))
    n = sum(counts.values())
    out = {}
    for i, text, _ in docs:
        out[i] = sum(math.log10(counts[t] / (n + prior) + (0 if t == scoring.END else prior / (n + prior) * math.exp(spelled[t]))) for t in scoring._tokens((text or "").encode()))
    return out


def test_scores_of_documents_are_sums_over_their_words(spark, monkeypatch):
    """With the model that the operator has learned, caught on the way."""
    caught = []
    real, prior = scoring._spelling, scoring._prior
    monkeypatch.setattr(scoring, "_spelling", lambda p, m: caught.append(m()) or real(p, m))
    monkeypatch.setattr(scoring, "_prior", lambda seen, n: caught.append(prior(seen, n)) or caught[-1])
    docs = [(1, "the cat the dog", False), (2, "a cat of zzyzx", True), (3, None, False), (4, "dogs the the of", False)]
    got = {r["doc_id"]: r["score"] for r in scoring.score_documents(spark.createDataFrame(docs, "doc_id long, text string, held_out boolean"), RANKS).collect()}
    (scores, stop), weight = caught
    lattice = scoring.Lattice(scoring.vocabulary(RANKS), scores, stop)
    words = {t for _, text, _ in docs for t in scoring._tokens((text or "").encode())}
    spelled = {w: lattice.spelled_long(w) if w != scoring.END else 0.0 for w in words}
    assert got == pytest.approx(brute_force(docs, spelled, weight))
