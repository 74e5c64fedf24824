import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from turnstile.llm import neardup
from turnstile.llm.queries import op7_minhash_neardup


def multiset(text, n=5):
    words = (text or "").lower().split()
    n = min(n, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def classes(docs, least=0.8):
    """All pairs in plain Python; docs: (id, text), ids distinct."""
    sets = {i: multiset(t) for i, t in docs}
    root = {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sum(sets[a].values()), sum(sets[b].values())
            if min(x, y) >= least * max(x, y) and find(a) != find(b) and similarity(sets[a], sets[b]) >= least:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in sets}


def test_matches_all_pairs_on_the_small_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = op7_minhash_neardup(spark, folder).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == classes(docs)
    size = Counter(r["class_id"] for r in got)
    assert all(r["class_size"] == size[r["class_id"]] for r in got)


def test_groups_of_copies_chains_and_bystanders(spark):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    docs, base = [], words(300)
    for k in range(60):  # near copies of one text, not all of 0.8 to each other
        own = base[:]
        for _ in range(rng.randrange(0, 6)):
            own[rng.randrange(300)] = f"edit{rng.randrange(10**6)}"
        docs.append((k, " ".join(own)))
    chain = words(200)
    for k in range(8):  # each near the next, the ends far apart
        docs.append((100 + k, " ".join(chain[k * 12 :] + [f"c{k}x{j}" for j in range(k * 12)])))
    docs += [(200 + k, " ".join(words(150))) for k in range(40)]
    docs += [(300, " ".join(base[:150] + words(150)))]  # half a copy
    got = neardup.group_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == classes(docs)


def test_nulls_empty_short_repeated_and_clashing_names(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Two words"), (5, "two  WORDS"), (6, "two other"), (None, "two words"), (None, None), (7, "same text here"), (7, "same text here"), (8, "x " * 60000), (9, "x " * 60000)]
    df = spark.createDataFrame([(*r, 5, "r") for r in rows], "doc_id long, text string, class_id int, rep string")
    got = neardup.group_near_duplicates(df).collect()
    assert len(got) == len(rows)
    found = defaultdict(set)
    for r in got:
        found[r["doc_id"]].add(r["class_id"])
    assert found == {1: {1}, 2: {2}, 3: {3}, 4: {4}, 5: {4}, 6: {6}, None: {None}, 7: {7}, 8: {8}, 9: {8}}
    assert {r["class_size"] for r in got if r["doc_id"] == 7} == {2}
    assert neardup.group_near_duplicates(df.limit(0)).count() == 0


def test_rows_of_one_id_are_in_the_class_of_their_own_text(spark):
    a, b = (" ".join(f"{p}{k}" for k in range(40)) for p in "ab")
    rows = [(5, a), (5, b), (5, b), (5, None), (5, ""), (6, a), (7, b + " end"), (8, "else")]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, class_id int")
    got = neardup.group_near_duplicates(df.withColumnRenamed("class_id", "row"), keep=["row"]).collect()
    assert [(r["class_id"], r["class_size"]) for r in sorted(got, key=lambda r: r["row"])] == [(5, 2), (5, 3), (5, 3), (5, 2), (5, 2), (5, 2), (5, 3), (8, 1)]
    # Of one smallest id, but not one class.
    key = {r["row"]: r["class_key"] for r in got}
    assert key[0] == key[5] and key[1] == key[2] == key[6] and key[3] == key[4] and len(set(key.values())) == 4


def test_long_near_copies_meet_in_blocks_of_bytes(spark, monkeypatch):
    """A bound of a few thousand cells cuts a bucket into many blocks and loses no link."""
    monkeypatch.setattr(neardup, "MEETING_CELLS", 3_000)
    rng = random.Random(9)
    docs = []
    for g in range(3):
        base = [f"g{g}w{rng.randrange(10**6)}" for _ in range(1_000)]
        for k in range(12):
            own = base[:]
            for _ in range(30):
                own[rng.randrange(1_000)] = f"e{rng.randrange(10**6)}"
            docs.append((100 * g + k, " ".join(own)))
    got = neardup.group_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == classes(docs)


def test_texts_of_megabytes(spark):
    long = " ".join(f"w{k}" for k in range(600_000))
    docs = [(1, long), (2, long + " more"), (3, "x" * 4_000_000), (4, "y " * 2_000_000)]
    got = neardup.group_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {1: 1, 2: 1, 3: 3, 4: 4}


@pytest.mark.parametrize("weights", [(1, 1), (3, 1)])
def test_coordinates_agree_as_often_as_texts_are_similar(weights):
    rng = np.random.default_rng(2)
    hits = total = 0
    share = []
    for _ in range(60):
        own = rng.integers(0, 1 << 62, 120).astype(np.uint64)
        left = np.repeat(own[:90], weights[0])
        right = np.concatenate([np.repeat(own[:60], weights[1]), own[90:]])
        zero = lambda x: np.zeros(len(x), np.int64)
        a, b = neardup.cells(left, zero(left))[0], neardup.cells(right, zero(right))[0]
        share.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        x, y = neardup.signatures(a, zero(a), 1, 100), neardup.signatures(b, zero(b), 1, 100)
        hits += (x == y).sum()
        total += 100
    assert hits / total == pytest.approx(np.mean(share), abs=0.03)


def test_documents_signed_together_are_signed_as_alone():
    texts = ["a b c d e f g", "", "x", "a b c d e f g", "one two three", " ".join(f"w{k}" for k in range(3000)), "r r r r r r r r r"]
    tokens = list(neardup.word_hashes(neardup.pa.array(texts), neardup.SPACES))
    together = list(neardup._signed(tokens, 5, 100, 4))
    assert together == [next(neardup._signed([t], 5, 100, 4)) for t in tokens]
    assert [n for _, _, _, n in together] == [3, 0, 1, 3, 1, 2996, 5]
