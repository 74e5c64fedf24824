"""Conversations in reply order, linked by what messages quote.

A message's lines are told apart by their quote level, the number of leading
``>`` signs. Quoted passages are normalised, cut into sentences and hashed; a
sentence is joined to the message of the same conversation that first said it in
its own words. A message replies to the one that most of its quoted words come
from. Replies are then put in order without the quotes.
"""

import re
from collections.abc import Callable

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.shared import batch, scratch, stored
from turnstile.llm.sharding import numbered

_LEVEL = re.compile(r"^[ \t]*((?:>[ \t]?)+)")
#: Lines that announce a quote, in the languages of common mail programs.
_ANNOUNCES = re.compile(r"^\s*(?:on\b.*\bwrote|am\b.*\bschrieb\b.*|le\b.*\ba écrit|el\b.*\bescribió|.*\bsaid|-+ ?original message ?-+)\s*:?\s*$", re.IGNORECASE)
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def parse(text: str | None) -> tuple[str | None, list[tuple[int, str]]]:
    """A message's own text, and its quoted passages with their levels.

    A line that announces a quote goes with it. Blank lines at either end of the
    own text are left out, others stay."""
    if text is None:
        return None, []
    own, passages = [], []
    for line in text.split("\n"):
        mark = _LEVEL.match(line)
        if not mark:
            own.append(line)
            if passages and passages[-1][0]:
                passages.append((0, []))  # ends the passage
            continue
        level = mark[1].count(">")
        if not (passages and passages[-1][0]):
            while own and not own[-1].strip():
                own.pop()
            if own and _ANNOUNCES.match(own[-1]):
                own.pop()
        rest = line[mark.end() :]
        if passages and passages[-1][0] == level:
            passages[-1][1].append(rest)
        elif not _ANNOUNCES.match(rest):
            passages.append((level, [rest]))
    found = [(level, " ".join(" ".join(part).split())) for level, part in passages if level]
    return "\n".join(own).strip("\n") if found else text, [(n, p) for n, p in found if p]


def sentences(passage: str) -> list[str]:
    """Normalised sentences: lower case, single spaces, no signs at either end."""
    parts = _SENTENCE.split(" ".join(passage.lower().split()))
    return [p for p in (part.strip(" .,;:!?\"'()[]*_-") for part in parts) if p]


def _units(passages: list[tuple[int, str]]) -> list[dict]:
    return [
        {"level": level, "hash": xxhash.xxh64_intdigest(s) - (1 << 63), "words": len(s.split())}
        for level, passage in passages
        for s in sentences(passage)
    ]


def _parsing(schema: pa.Schema) -> Callable:
    def run(batches):
        for b in batches:
            own, quoted, said, passages = [], [], [], []
            for text in b.column("text").to_pylist():
                mine, quotes = parse(text)
                own.append(mine)
                quoted.append(_units(quotes))
                passages.append(len(quotes))
                said.append(_units([(0, mine or "")]))
            kept = [b.column(n) for n in schema.names[:-4]]
            yield batch(schema, *kept, own, passages, quoted, said)

    return run


def reply_order(
    messages: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row for each message: conv_id, turn, role, text (own words), quotes
    (passages), parent_turn, root_turn, depth, position (from 0 in its conversation).

    Parent: of the messages of an earlier turn that first said quoted sentences,
    the one of most quoted words, the later at a tie; the least nested level that
    finds any decides. Without a link parent_turn is null, and the message is a
    root of depth 0. Order: depth first, replies to one message by turn, so that a
    message stands behind what it replies to with nothing but earlier replies to that
    between. A row carries the turns above it, as many as it is deep. Rows of one conversation and turn are linked alike and stand
    next to each other, by role and text. Null texts stay null and quote nothing;
    a text of quotes only becomes empty. Rows with a null conversation or turn
    are not linked and come first. Other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = messages.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    unit = "array<struct<level:int,hash:long,words:int>>"
    out = rows.select("conv_id", "turn", "role", F.lit(None).cast("string").alias("own"), F.lit(None).cast("int").alias("quotes"), F.lit(None).cast(unit).alias("quoted"), F.lit(None).cast(unit).alias("said")).schema
    key = ["conv_id", "turn"]
    with scratch(messages.sparkSession) as kept:
        parsed = kept.stored(rows.mapInArrow(_parsing(to_arrow_schema(out)), out), "messages")
        named = parsed.where("conv_id is not null and turn is not null")
        quoted = named.select(*key, F.explode("quoted").alias("u")).select(*key, "u.level", "u.hash", "u.words")
        # Only what is quoted is looked for among what was said.
        asked = kept.stored(quoted.groupBy(*key, "level", "hash").agg(F.sum("words").alias("words")), "quoted")
        wanted = asked.select("conv_id", "hash").distinct()
        said = named.select(*key, F.explode("said.hash").alias("hash")).join(wanted, ["conv_id", "hash"], "left_semi")
        first = kept.stored(said.groupBy("conv_id", "hash").agg(F.min("turn").alias("source")), "first-said")
        candidates = asked.join(first, ["conv_id", "hash"]).where(F.col("source") < F.col("turn")).groupBy(*key, "level", "source").agg(F.sum("words").alias("words"))
        # Smallest level, most words, latest source.
        best = F.max(F.struct((-F.col("level")).alias("level"), "words", "source"))
        links = kept.stored(candidates.groupBy(*key).agg(best.getField("source").alias("parent")), "links")
        # Pointer doubling: each round doubles how far a message sees.
        seen = kept.stored(links.select(*key, F.col("parent").alias("root"), F.array("turn").alias("path")), "seen")
        while True:
            above = seen.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("top"), F.col("path").alias("more"))
            new = kept.stored(
                seen.join(above, ["conv_id", "root"], "left").select(*key, F.coalesce("top", "root").alias("root"), F.when(F.col("more").isNull(), F.col("path")).otherwise(F.concat("more", "path")).alias("path"), F.col("top").isNotNull().alias("moved")),
                "seen",
            )
            seen = new.drop("moved")
            if not new.where("moved").limit(1).count():
                break
        linked = parsed.drop("quoted", "said").join(links, key, "left").join(seen, key, "left")
        # The turns from a message's root down to it: in their order a reply and all that
        # replies to it come right behind what it replies to.
        way = F.when(F.col("path").isNull(), F.array("turn")).otherwise(F.concat(F.array("root"), "path"))
        linked = linked.select(*key, "role", F.col("own").alias("text"), "quotes", F.col("parent").alias("parent_turn"), F.coalesce("root", "turn").alias("root_turn"), F.coalesce(F.size("path"), F.lit(0)).alias("depth"), way.alias("way"))
        placed = numbered(linked, ["conv_id", "way", "role", "text"], "row_no").drop("way")
        # The numbers of a conversation are gapless: its first one makes positions.
        start = kept.stored(placed.groupBy("conv_id").agg(F.min("row_no").alias("start")), "starts")
        ordered = placed.join(start, placed["conv_id"].eqNullSafe(start["conv_id"])).select(placed["*"], (F.col("row_no") - F.col("start")).alias("position")).drop("row_no")
        return stored(ordered, "reply-order")
