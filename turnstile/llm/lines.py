"""Line dedup by a tree of line templates.

A line's tokens are masked where they are variable by form (numbers, hex,
addresses, links). The tree is of fixed depth: token count, then the leading
tokens. In a leaf, lines that share any of several parts are held place by place
against the earliest line with that part; those that agree in enough places are
one template, with wildcards where they differ. A template met in several
documents stays in the first of them, its lines are dropped from the others. Short
lines recur by chance; theirs go where they recur together with their neighbours.

Only DataFrame functions. Lines are compared by 64-bit hashes. A bitmap of the keys
that matter goes before each shuffle, so that only lines which may recur, and texts
which may lose some, are moved.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.shared import Marks, Scratch, scratch, stored

#: Lines for a file of each table that follows from them.
LINES_A_FILE = 100_000
#: What a mask makes of a variable token.
WILDCARD = "<*>"
#: Forms of variable tokens, whole ones within a line. The address is looked for behind the
#: first @ alone, since a search behind each of many would take the square of their number.
_VARIABLE = r"(?<!\S)(?:\S*\d\S*|https?://\S+|www\.\S+|\S[^@\s]*+@\S+\.\S+)(?!\S)"
#: Signs without which a line has no variable token, but for www, and white space other than
#: blanks. Single signs are looked up in a table, a range or a choice would be tried one by one.
_ODD = r"[\t\n\x0b\f\r0123456789@/]"


def _masked_line(line: Column) -> Column:
    """The line's tokens with single blanks between, variable ones as wildcards."""
    # Most lines have nothing to mask and single blanks only, which one look tells.
    odd = line.rlike(_ODD) | line.contains("  ") | line.contains("www.")
    return F.when(odd, F.regexp_replace(F.trim(F.regexp_replace(line, r"\s+", " ")), _VARIABLE, WILDCARD)).otherwise(F.trim(line))


def masked(line: Column) -> Column:
    """The line's tokens, variable ones as wildcards."""
    return F.split(_masked_line(line), " ")


#: Classes of places, and contiguous segments, by which similar lines meet.
_CLASSES, _SEGMENTS = (2, 3, 4), 8


def _parts(leaf: Column, cells: Column, leading: int) -> Column:
    """Hashes of parts of a line: its leaf alone, every second, third and fourth
    place, and segments of what follows the leading tokens."""
    after = F.greatest(F.size(cells) - leading, F.lit(0))
    edge = lambda k: F.floor(after * k / _SEGMENTS).cast("int")
    place = lambda n, c: F.filter(cells, lambda _, i: i % n == c)
    found = [F.xxhash64(F.lit("leaf"), leaf)]
    found += [F.xxhash64(F.lit(f"{n}/{c}"), leaf, place(n, c)) for n in _CLASSES for c in range(n)]
    for k in range(_SEGMENTS):
        size = edge(k + 1) - edge(k)
        found.append(F.when(size > 0, F.xxhash64(F.lit(f"segment {k}"), leaf, F.slice(cells, edge(k) + leading + 1, size))))
    return F.array_compact(F.array(*found))


def _repeated(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Groups that hold more than one value; partial sums of two numbers a group."""
    found = rows.groupBy(group).agg(F.min(value).alias("a"), F.max(value).alias("b"))
    return found.where("a != b").select(group)


def _similar(kept: Scratch, lines: DataFrame, leading: int, least: float) -> DataFrame:
    """(whole, first): lines that agree with one of an earlier document in a share
    ``least`` of their places, three of them no wildcards, and that document.

    Lines meet the earliest line of each part, so no two rows of a large group are
    paired. What found none meets the earliest of those that are left, and so on
    until a round links no line.
    """
    own = lines.where("long").select("leaf", "whole", "doc", "masked")
    shared = kept.stored(_repeated(own, "leaf", "whole"), "shared-leaves")
    alike = Marks(shared, "leaf").within(own, F.col("leaf")).groupBy("leaf", "whole").agg(F.min("doc").alias("first"), F.first("masked").alias("masked"))
    # Only these lines are compared place by place; a few of all.
    near = kept.stored(
        alike.select("leaf", "whole", "first", F.transform(F.split("masked", " "), lambda t: F.hash(t)).alias("cells")),
        "lines-of-shared-leaves",
    )
    parts = kept.stored(
        near.select("whole", "first", F.explode(_parts(F.col("leaf"), F.col("cells"), leading)).alias("part")),
        "parts-of-lines",
    )
    common = kept.stored(_repeated(parts, "part", "whole"), "shared-parts")
    left = kept.stored(Marks(common, "part").within(parts, F.col("part")), "parts")
    cells, linked = near.select("whole", "cells"), None
    same = F.zip_with("cells", "others", lambda x, y: F.when(x == y, x))
    agreeing = F.filter(same, lambda x: x.isNotNull())
    telling = F.filter(agreeing, lambda x: x != F.hash(F.lit(WILDCARD)))
    while True:
        earliest = left.groupBy("part").agg(F.min(F.struct("first", "whole")).alias("rep"))
        met = left.join(earliest, "part").withColumn("leads", F.col("rep.whole") == F.col("whole"))
        pairs = kept.stored(
            met.where(F.col("rep.first") < F.col("first")).select("whole", F.col("rep.whole").alias("other"), F.col("rep.first").alias("earlier")).distinct(),
            "pairs",
        )
        mine, theirs = (Marks(pairs.select(c).distinct(), c).within(cells, F.col("whole")) for c in ("whole", "other"))
        found = kept.stored(
            pairs.join(mine, "whole")
            .join(theirs.select(F.col("whole").alias("other"), F.col("cells").alias("others")), "other")
            .where((F.size(agreeing) >= F.size("cells") * F.lit(least)) & (F.size(telling) >= 3))
            .groupBy("whole")
            .agg(F.min("earlier").alias("first")),
            "linked",
        )
        linked = found if linked is None else linked.unionByName(found)
        if not found.limit(1).count():
            return linked
        # Neither a line that is linked nor one that led is met in its part again.
        again = met.where(~F.col("leads") & (F.col("rep.first") < F.col("first"))).select("whole", "first", "part").join(found.select("whole"), "whole", "left_anti")
        left = kept.stored(again, "parts-left")


#: Letters of scripts that put no spaces between words; each counts as a token.
_UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def _weight(line: Column, tokens: Column, min_tokens: int) -> Column:
    """How many tokens the line counts for, or any number from ``min_tokens`` on."""
    # Such a letter takes three bytes; both spare most lines the look.
    some = (F.size(tokens) < min_tokens) & (F.octet_length(line) >= F.length(line) + 2)
    return F.when(some, F.greatest(F.size(tokens), F.regexp_count(line, F.lit(_UNSPACED)))).otherwise(F.size(tokens))


def _short_runs(kept: Scratch, own: DataFrame, min_tokens: int) -> DataFrame:
    """(key, at): short lines that recur with their neighbours in an earlier document.

    A run starts at a short line and takes the lines after it, or before it, until
    it has ``min_tokens`` tokens. ``own``: lines that recur themselves, as only they
    can be in one that does.
    """
    order = Window.partitionBy("doc").orderBy("nth")

    def run(move, step):
        size, total = F.lit(None).cast("int"), F.col("weight")
        for k in range(1, min_tokens):
            total = total + move("weight", k).over(order)
            # Null or another number if a line between does not recur.
            joined = move("nth", k).over(order) == F.col("nth") + step * k
            size = F.coalesce(size, F.when(joined & (total >= min_tokens), k + 1))
        every = lambda c: F.slice(F.array(F.col(c), *(move(c, k).over(order) for k in range(1, min_tokens))), 1, size)
        # In the order of the text, so that both ways give one hash for one run.
        turned = (lambda c: every(c)) if step > 0 else (lambda c: F.reverse(every(c)))
        places = F.filter(F.transform(F.arrays_zip(every("at").alias("at"), every("long").alias("long")), lambda x: F.when(~x["long"], x["at"])), lambda x: x.isNotNull())
        return F.when(~F.col("long") & size.isNotNull(), F.struct(F.xxhash64(turned("whole")).alias("run"), places.alias("places")))

    runs = kept.stored(
        own.select("doc", F.array(run(F.lead, 1), run(F.lag, -1)).alias("runs")).select("doc", F.explode(F.array_compact("runs")).alias("r")).select("doc", "r.run", "r.places"),
        "short-runs",
    )
    first = runs.groupBy("run").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first != last").select("run", "first")
    return runs.join(first, "run").where(F.col("doc") > F.col("first")).select(F.col("doc.key").alias("key"), F.explode("places").alias("at"))


def drop_recurring_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    leading: int = 3,
    min_tokens: int = 5,
    similarity: float = 0.5,
    length: str | None = None,
) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text``, and ``lines_dropped`` long.

    A line of ``min_tokens`` or more goes if an earlier document, earlier by (id,
    nulls last, then content), holds one of its template: as many tokens, the same
    ``leading`` ones, and a share ``similarity`` of equal places, wherever they are.
    Shorter lines recur by chance in prose; theirs go if they recur together with the
    lines next to them, ``min_tokens`` tokens in all, whatever the size of the table.
    A letter of a script without spaces counts as a token. Repeats within one document
    stay. ``length``: a column to hold the new text's number of characters where lines
    were dropped.

    Documents are told apart by id and text: equal rows count as one document and
    all get the same result. Null texts stay null, empty ones empty, blank lines
    are no lines. A line may be as long as the text; the work on it is linear in its
    length. A row keeps all its other columns, whatever their names.
    """
    spark = docs.sparkSession
    names = docs.columns
    cell = lambda c: F.col(f"`{c}`")
    key = F.xxhash64(cell(doc_id), cell(text))
    # Copies sort by content hash, documents without id after all others.
    order = F.struct(cell(doc_id).isNull().alias("none"), cell(doc_id).alias("id"), key.alias("key"))
    weight = _weight(F.col("line"), F.col("tokens"), min_tokens)
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, leading))
    numbered = F.filter(F.transform(F.split(cell(text).cast("string"), "\n"), lambda line, i: F.struct(i.alias("at"), line.alias("line"))), lambda x: x["line"].rlike(r"\S"))
    split_lines = docs.where(cell(text).isNotNull()).select(order.alias("doc"), F.posexplode(numbered).alias("nth", "l")).select("doc", "nth", "l.at", "l.line")
    with scratch(spark) as kept:
        lines = kept.stored(
            split_lines.select("doc", "at", "nth", "line", _masked_line(F.col("line")).alias("masked"))
            .select("*", F.split("masked", " ").alias("tokens"))
            .select(
                "doc", "at", "nth", weight.alias("weight"), (weight >= min_tokens).alias("long"), leaf.alias("leaf"),
                F.xxhash64(leaf, "tokens").alias("whole"), "masked",
            ),
            "line-templates",
        )
        kept.sized(lines.count(), LINES_A_FILE)
        several = kept.stored(_repeated(lines.select("whole", F.col("doc.key").alias("key")), "whole", "key"), "recurring-templates")
        recurring = Marks(several, "whole").within(lines.select("doc", "whole"), F.col("whole")).join(several, "whole").groupBy("whole").agg(F.min("doc").alias("first"))
        similar = _similar(kept, lines, leading, similarity)
        # One row a template: the first document of it and of what is like it.
        known = kept.stored(
            recurring.withColumn("met", F.lit(True)).unionByName(similar.withColumn("met", F.lit(False))).groupBy("whole").agg(F.min("first").alias("first"), F.max("met").alias("met")),
            "templates",
        )
        held = kept.stored(
            Marks(known, "whole").within(lines.drop("masked", "leaf"), F.col("whole")).join(known, "whole"),
            "recurring-lines",
        )
        gone = held.where(F.col("long") & (F.col("doc") > F.col("first"))).select(F.col("doc.key").alias("key"), "at")
        gone = gone.unionByName(_short_runs(kept, held.where("met").drop("first", "met"), min_tokens))
        # The one thing that outlives the block: a row for each document that loses lines.
        dropped = stored(kept.gathered(gone.groupBy(F.col("key").alias("__key")).agg(F.collect_set("at").alias("__gone"))), "dropped-lines")
    split = F.split(F.col("__text"), "\n")
    left = F.array_join(F.filter(split, lambda _, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    whole = docs.select(F.struct(*(cell(c) for c in names)).alias("__row"), cell(text).cast("string").alias("__text"), key.alias("__key"))
    losing, others = Marks(dropped, "__key").split(whole, F.col("__key"))
    joined = losing.join(dropped, "__key", "left").withColumn("__left", F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(left))
    fields = [F.col("__row").getField(c).alias(c) for c in names]
    kept_as_is = others.select(*fields, F.lit(0).cast("long").alias("lines_dropped"))
    out = {c: f for c, f in zip(names, fields, strict=True)}
    out[text] = F.col("__left").alias(text)
    if length in out:
        changed = F.when(F.col("__gone").isNull(), F.col("__row").getField(length)).otherwise(F.length("__left"))
        out[length] = changed.cast(docs.schema[length].dataType).alias(length)
    return joined.select(*out.values(), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("lines_dropped")).unionByName(kept_as_is)
