import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from turnstile.llm import lines, shared

LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


MASK = re.compile(r"(?:\S*\d\S*|https?://\S+|www\.\S+|\S+@\S+\.\S+)", re.S)
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")


def similar(a, b, least=0.5):
    same = [x for x, y in zip(a, b, strict=True) if x == y]
    return len(same) >= least * len(a) and sum(x != lines.WILDCARD for x in same) >= 3


def plain(docs, min_tokens=5, leading=3):
    """The operator in plain Python, by a search of all pairs; docs: (id, text)."""
    order = sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0, d[1] or ""))
    rank = {d: i for i, d in enumerate(order)}
    held, leaves, parsed = defaultdict(set), defaultdict(set), {}
    for d in order:
        rows = []
        for at, line in enumerate((d[1] or "").split("\n")):
            tokens = tuple(lines.WILDCARD if MASK.fullmatch(t) else t for t in line.split())
            if tokens:
                rows.append((at, tokens, max(len(tokens), len(UNSPACED.findall(line)))))
                held[tokens].add(rank[d])
                if rows[-1][2] >= min_tokens:
                    leaves[len(tokens), tokens[:leading]].add(tokens)
        parsed[rank[d]] = rows
    first = {t: min(r) for t, r in held.items()}
    recurs = {t for t, r in held.items() if len(r) > 1}
    like = dict(first)
    for leaf in leaves.values():
        for t in leaf:
            like[t] = min([first[t], *(first[u] for u in leaf if u != t and first[u] < first[t] and similar(t, u))])
    runs = defaultdict(list)
    for r, rows in parsed.items():
        for k, (_, tokens, weight) in enumerate(rows):
            for step in (1, -1):
                part, total = [], 0
                while 0 <= k + step * len(part) < len(rows) and total < min_tokens and len(part) < min_tokens:
                    row = rows[k + step * len(part)]
                    if row[1] not in recurs:
                        break
                    part.append(row)
                    total += row[2]
                if weight < min_tokens <= total:
                    key = tuple(x[1] for x in part[::step])
                    runs[key].append((r, [at for at, _, w in part if w < min_tokens]))
    gone = defaultdict(set)
    for r, rows in parsed.items():
        gone[r] |= {at for at, t, w in rows if w >= min_tokens and like[t] < r}
    for found in runs.values():
        least = min(r for r, _ in found)
        for r, places in found:
            if r > least:
                gone[r] |= set(places)
    out = []
    for d in docs:
        left = [line for at, line in enumerate((d[1] or "").split("\n")) if at not in gone[rank[d]]]
        out.append((d[0], None if d[1] is None else "\n".join(left)))
    return sorted(out, key=str)


def run(spark, docs, **more):
    df = spark.createDataFrame([(d, t, "k", len(t or "")) for d, t in docs], "doc_id long, text string, key string, n_chars long")
    return lines.drop_recurring_lines(df, length="n_chars", **more)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_equals_a_search_of_all_pairs(spark, folder):
    """With the parameters that the query and the pipeline use."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").collect()]
    got = run(spark, docs).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == plain(docs)
    assert all(r["n_chars"] == len(r["text"]) for r in got if r["lines_dropped"])
    assert sum(r["lines_dropped"] for r in got) > 0


def test_a_line_left_by_the_earliest_meets_the_next(spark):
    """The first line of a part is like none; two behind it are like each other."""
    words = LONG.split()
    first = " ".join(words[:5] + [f"x{c}" for c in "abcdefghi"])
    one = " ".join(words[:5] + [f"y{c}" for c in "abcdefghi"])
    two = " ".join(words[:5] + [f"y{c}" for c in "abcdef"] + ["za", "zb", "zc"])
    docs = [(1, first), (2, one), (3, two)]
    assert {r["doc_id"]: r["text"] for r in run(spark, docs).collect()} == dict(plain(docs)) == {1: first, 2: one, 3: ""}


def test_marks_of_a_word_cost_time_in_proportion(spark):
    """A megabyte of signs that could start an address, as one token."""
    texts = ["@" * 1_000_000, "a@" * 500_000, "a@b." + "." * 1_000_000, "x" * 4_000_000]
    start = time.time()
    got = {r["doc_id"]: r for r in run(spark, list(enumerate(texts))).collect()}
    assert [got[i]["text"] for i in range(4)] == texts
    assert time.time() - start < 60
    start = time.time()
    mask = spark.createDataFrame([(t,) for t in texts], "t string").select(F.size(lines.masked(F.col("t"))).alias("n"))
    assert [r.n for r in mask.collect()] == [1] * 4
    assert time.time() - start < 5


@pytest.mark.parametrize("token", ["a@b.c", "@@b.c", "a@@.c", "a@.c", "@a.c", "a@b.", "a@b.c.", "a@b..", "é@ü.ß", "a@b", "x1", "http://x", "https://", "www.a", "www.", "-", "a.b@c"])
def test_masked_tokens_are_those_of_the_plain_pattern(spark, token):
    got = spark.createDataFrame([(token,)], "t string").select(lines.masked(F.col("t"))).first()[0]
    assert got == [lines.WILDCARD if MASK.fullmatch(token) else token]


def test_a_line_is_masked_as_its_tokens_are(spark):
    """Words next to each other, odd blanks, signs beyond ASCII; the same whether looked at alone or in a line."""
    tokens = ["a@b.c", "a@", "@a.c", "b@c.d", "x1", "http://x", "https://", "www.a", "www.", "a/b", "é@ü.ß", "\u00a0", "\u2028", "1\u2028", "\U0001f600", "\U0001f6007", "a.b@c", "<*>"]
    lines_ = [" ".join(tokens), "\t".join(tokens[::-1]), "  ".join(tokens[3:]) + " \r", " \x0b".join(tokens[::2]), " a plain line ", "www.a", "one\u00a0two @ three", "a@b c.d", "a @b.c"]
    df = spark.createDataFrame(list(enumerate(lines_)), "i int, t string").select("i", lines.masked(F.col("t")).alias("m"))
    got = {r["i"]: r["m"] for r in df.collect()}
    for i, line in enumerate(lines_):
        want = [t for t in re.split(r"[ \t\n\x0b\f\r]+", line) if t]
        assert got[i] == [lines.WILDCARD if re.fullmatch(MASK.pattern, t, re.S | re.A) else t for t in want], line


def test_only_lines_that_may_be_alike_are_taken_apart(spark, monkeypatch):
    """Hashes of every place are worked out for lines of shared leaves alone, and each line's parts once."""
    seen, stored = {}, shared.Scratch.stored

    def watched(self, df, name):
        seen[name] = stored(self, df, name)
        seen[f"{name} rows"] = seen[name].count()
        return seen[name]

    monkeypatch.setattr(shared.Scratch, "stored", watched)
    near = LONG.replace("five", "V").replace("nine", "IX")
    docs = [(1, LONG), (2, near), *((k, f"only {chr(97 + k)} line of this kind is here") for k in range(3, 20))]
    got = {r["doc_id"]: r["lines_dropped"] for r in run(spark, docs).collect()}
    assert got == {k: int(k == 2) for k in range(1, 20)}
    assert "cells" not in seen["line-templates"].columns
    assert (seen["line-templates rows"], seen["lines-of-shared-leaves rows"]) == (19, 2)
    assert 2 < seen["parts-of-lines rows"] <= 2 * 18


def test_a_recurring_line_stays_in_its_first_document(spark):
    got = {r["doc_id"]: r for r in run(spark, [(3, f"c\n{LONG}"), (1, f"{LONG}\na"), (2, f"b\n{LONG}\n{LONG}")]).collect()}
    assert [got[k]["text"] for k in (1, 2, 3)] == [f"{LONG}\na", "b", "c"]
    assert [got[k]["lines_dropped"] for k in (1, 2, 3)] == [0, 2, 1]


@pytest.mark.parametrize("other", ["User 99 logged in from 10.1.1.1", "User a7 logged in from host4"])
def test_variable_fields_do_not_tell_lines_apart(spark, other):
    got = {r["doc_id"]: r["text"] for r in run(spark, [(1, "User 17 logged in from 10.0.0.7"), (2, other), (3, "User seventeen logged in from home")]).collect()}
    assert got[2] == "" and got[3] == "User seventeen logged in from home"


def test_long_lines_with_other_words_at_some_places_are_one_template(spark):
    near = LONG.replace("five", "V").replace("nine", "IX")
    far = " ".join(w if i < 3 else f"w{'abcdefghijklmno'[i]}" for i, w in enumerate(LONG.split()))
    got = {r["doc_id"]: r["text"] for r in run(spark, [(1, LONG), (2, near), (3, far)]).collect()}
    assert got == {1: LONG, 2: "", 3: far}


def test_short_lines_recur_by_chance(spark):
    """A short line alone stays, however many documents hold it and however many there are."""
    for n in (19, 600):
        docs = [(k, f"The end.\n{chr(97 + k % 26)}{k}x of it alone here now {'abcdefghijklmnopqrstuvwxyz'[k % 26] * (k // 26 + 1)}") for k in range(n)]
        assert not any(r["text"].count("The end.") != 1 for r in run(spark, docs).collect())


def test_nulls_blanks_repeats_and_names(spark):
    docs = [(None, f"x\n{LONG}"), (1, LONG), (1, LONG), (2, None), (3, ""), (4, " \n\t\n"), (5, LONG + "\n" + LONG)]
    got = run(spark, docs).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(
        [(None, "x"), (1, LONG), (1, LONG), (2, None), (3, ""), (4, " \n\t\n"), (5, "")], key=str
    )
    assert {r["key"] for r in got} == {"k"}
    assert run(spark, []).count() == 0


def test_edits_at_both_parities_and_short_lines_with_a_name(spark):
    edited = LONG.replace("five", "V").replace("ten", "X")  # an even and an odd place
    short = ["Photo taken by Anna in Ulm", "Photo taken by Bernd in Ulm"]
    far = "one two three " + " ".join(f"w{'abcdefghijk'[i]}" for i in range(11))
    docs = [(1, f"{LONG}\n{short[0]}"), (2, f"{edited}\nkept\n{short[1]}"), (3, far)]
    got = {r["doc_id"]: r["text"] for r in run(spark, docs).collect()}
    assert got == {1: f"{LONG}\n{short[0]}", 2: "kept", 3: far}


def test_short_lines_go_by_their_neighbours(spark):
    song = "Row row\nrow your boat\n\nGently\ndown the stream\nMerrily"
    han = "今天天气很好"
    docs = [(1, f"Home\n{song}\n{han}"), (2, f"mine\n{song}\nown words\nIt."), (3, f"{han}\nother\ndown the stream"), (4, f"{LONG}\nRead on"), (5, f"{LONG}\nRead on")]
    got = {r["doc_id"]: r["text"] for r in run(spark, docs).collect()}
    assert got == dict(plain(docs)) == {1: docs[0][1], 2: "mine\n\nown words\nIt.", 3: "other\ndown the stream", 4: docs[3][1], 5: ""}


def test_marks_let_all_that_match_pass(spark):
    keys = spark.range(5_000).select((F.col("id") * 7).alias("k"))
    rows = spark.range(60_000).select(F.col("id").alias("k"))
    marks = shared.Marks(keys, "k")
    within, others = marks.split(rows, F.col("k"))
    inside = {r.k for r in within.collect()}
    assert {k for k in range(60_000) if k % 7 == 0 and k < 35_000} <= inside and len(inside) < 5_600
    assert others.count() == 60_000 - len(inside)
    empty = shared.Marks(keys.limit(0), "k")
    assert empty.within(rows, F.col("k")).count() == 0 and empty.split(rows, F.col("k"))[1].count() == 60_000
