import random

from turnstile.llm import quotes
from turnstile.llm.queries import op10_quotation_linking

FIRST = "Hello all. Where shall we meet on Friday?\nI would prefer the old office."
SECOND = "On Monday Ann wrote:\n> Hello all. Where shall we\n> meet on Friday?\n\nThe new office has more room."
THIRD = "Bob said:\n> On Monday Ann wrote:\n>> I would prefer the old office.\n> The new office has more room.\nAgreed, the new one."
FOURTH = "> Hello all. Where shall we meet on Friday?\nFriday does not suit me."


def test_parse_tells_levels_apart():
    assert quotes.parse(THIRD) == ("Agreed, the new one.", [(2, "I would prefer the old office."), (1, "The new office has more room.")])
    assert quotes.parse("no quote > here") == ("no quote > here", [])
    assert quotes.parse("> only") == ("", [(1, "only")])
    assert quotes.parse(None) == (None, []) and quotes.parse("") == ("", [])
    assert quotes.parse("a\n> x\nb\n>> y\n\nc") == ("a\nb\n\nc", [(1, "x"), (2, "y")])


def test_replies_are_linked_and_ordered(spark):
    rows = [
        (1, 0, "user", FIRST), (1, 1, "user", "Something else entirely. Nothing to see."), (1, 2, "user", SECOND), (1, 3, "user", THIRD),
        (1, 4, "user", FOURTH), (2, 0, "user", "Other talk."), (2, 1, "user", "> Where shall we meet on Friday?\nnot from here"), (1, 5, "user", "> Nothing to see.\nI see."),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    got = {(r["conv_id"], r["turn"]): r for r in quotes.reply_order(df).collect()}
    assert len(got) == 8
    link = {k: (r["parent_turn"], r["root_turn"], r["depth"]) for k, r in got.items()}
    assert link[1, 2] == (0, 0, 1) and link[1, 3] == (2, 0, 2) and link[1, 4] == (0, 0, 1) and link[1, 5] == (1, 1, 1)
    assert link[2, 1] == (None, 1, 0) and link[1, 0] == (None, 0, 0)
    assert [k[1] for k in sorted((k for k in got if k[0] == 1), key=lambda k: got[k]["position"])] == [0, 2, 3, 4, 1, 5]
    assert got[1, 2]["text"] == "The new office has more room." and got[2, 1]["text"] == "not from here"


def brute(rows):
    """Parents and depth-first order by plain loops; rows: (conv, turn, text)."""
    parsed = {(c, t): quotes.parse(x) for c, t, x in rows}
    own = {k: [s for s in quotes.sentences(m or "")] for k, (m, _) in parsed.items()}
    out, parent = {}, {}
    for (c, t), (_, passages) in parsed.items():
        found = {}
        for level, passage in passages:
            for s in quotes.sentences(passage):
                # Who said it first, of all turns; a later one says nothing new.
                said = min((u for (d, u), x in own.items() if d == c and s in x), default=None)
                if said is not None and said < t:
                    found[level, said] = found.get((level, said), 0) + len(s.split())
        if found:
            level = min(n for n, _ in found)
            parent[c, t] = max((w, u) for (n, u), w in found.items() if n == level)[1]
    for c, t in parsed:
        way = [t]
        while (c, way[0]) in parent:
            way.insert(0, parent[c, way[0]])
        out[c, t] = (parent.get((c, t)), way[0], len(way) - 1, way)
    place = {}
    for c in {c for c, _ in out}:
        for i, k in enumerate(sorted((k for k in out if k[0] == c), key=lambda k: out[k][3])):
            place[k] = i
    return {k: (*v[:3], place[k]) for k, v in out.items()}


def test_generated_threads_equal_plain_python(spark):
    """Replies that quote one or two earlier messages, nested, in part, with and without announcing lines."""
    rng = random.Random(11)
    rows = []
    for c in range(25):
        texts = []
        for t in range(rng.randrange(1, 14)):
            words = lambda: " ".join(rng.choice(["red", "blue", "tree", "stone", "river", "cloud"]) + str(rng.randrange(40)) for _ in range(rng.randrange(2, 7)))
            said = [f"{words()}." for _ in range(rng.randrange(1, 4))]
            if texts and rng.random() < 0.2:
                said.append(rng.choice(rng.choice(texts)[1]))  # says again what another said
            lines = []
            for _ in range(rng.randrange(0, 3) if texts else 0):
                level = rng.randrange(1, 4)
                if rng.random() < 0.5:
                    lines.append(">" * (level - 1) + ("On Monday Ann wrote:" if level == 1 else " On Monday Ann wrote:"))
                lines += [">" * level + " " + s for s in rng.choice(texts)[1] if rng.random() < 0.8]
            lines += said
            texts.append(("\n".join(lines), said))
        rows += [(c, t, x) for t, (x, _) in enumerate(texts)]
    df = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string").repartition(6)
    got = {(r["conv_id"], r["turn"]): (r["parent_turn"], r["root_turn"], r["depth"], r["position"]) for r in quotes.reply_order(df).collect()}
    want = brute(rows)
    assert got == want
    assert sum(v[0] is not None for v in want.values()) > 40 and max(v[2] for v in want.values()) > 2


def test_a_reply_stands_by_what_it_replies_to(spark):
    """Depth first: a late reply to an early message comes before the next root's thread and behind the earlier replies."""
    rows = [(1, 0, "Alpha one two."), (1, 1, "Beta three four."), (1, 2, "> Alpha one two.\nGamma five."), (1, 3, "> Beta three four.\nDelta six."), (1, 4, "> Gamma five.\nNu."), (1, 5, "> Alpha one two.\nXi."), (1, 6, "> Gamma five.\nPi.")]
    df = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    assert [r["turn"] for r in sorted(quotes.reply_order(df).collect(), key=lambda r: r["position"])] == [0, 2, 4, 6, 5, 1, 3]


def test_a_long_chain_of_replies(spark):
    rows = [(7, 0, "Message number zero stands here.")]
    for k in range(1, 40):
        rows.append((7, k, f"> Message number {'abcdefghijklmnopqrstuvwxyz'[k % 26] * k if k > 1 else 'zero'} stands here.\nMessage number {'abcdefghijklmnopqrstuvwxyz'[(k + 1) % 26] * (k + 1)} stands here."))
    df = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r for r in quotes.reply_order(df).collect()}
    assert all(got[k]["depth"] == k and got[k]["root_turn"] == 0 for k in range(40))


def test_nulls_repeats_and_no_rows(spark):
    rows = [(1, 0, "a", "One two three."), (1, 0, "a", "One two three."), (1, 1, "b", "> One two three."), (1, 2, "b", None), (None, 1, "c", "> x"), (2, None, "c", "y"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.reply_order(df).collect()
    assert len(got) == 7
    one = {(r["turn"], r["position"]): r for r in got if r["conv_id"] == 1}
    assert set(one) == {(0, 0), (0, 1), (1, 2), (2, 3)}
    assert one[1, 2]["parent_turn"] == 0 and one[1, 2]["text"] == "" and one[2, 3]["text"] is None
    assert quotes.reply_order(df.limit(0)).count() == 0


def test_without_quotes_the_order_is_that_of_turns(spark):
    got = op10_quotation_linking(spark, "/root/testdata/sf0.001").collect()
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    assert sorted((r["conv_id"], r["turn"], r["text"]) for r in got) == sorted((r["conv_id"], r["turn"], r["text"]) for r in given)
    assert all(r["parent_turn"] is None and r["position"] == r["turn"] for r in got)
