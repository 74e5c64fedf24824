"""Near-duplicate documents by DartMinHash signatures, banded joining and exact checks.

Word shingles are elements, their numbers of occurrences the weights. Darts are
thrown at the plane of weight and rank: each unit of an element's weight gets a
hashed Poisson stream of darts by rank, and each dart a coordinate. A document's
signature keeps the earliest dart of each coordinate, so two documents agree
on a coordinate with the chance of their weighted Jaccard similarity.

Documents that share a band of coordinates are held against one member of the
bucket, exactly. What is then still in several classes within one bucket is held
against the bucket's other classes, so no link of the buckets is lost, while
members of one class are never paired.
"""

from collections.abc import Callable, Iterator, Sequence
from hashlib import blake2b
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.shared import SPACES, Marks, Scratch, batch, parts, scratch, stored, word_hashes

#: Members of a bucket in one task, and their cells of four bytes.
MEETING, MEETING_CELLS = 4_096, 8 << 20
#: Documents for a file of each table that follows from them.
DOCS_A_FILE = 10_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Evenly spread 64-bit hashes of 64-bit numbers."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(tokens: np.ndarray, doc: np.ndarray, count: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of ``count`` documents and the documents they are of. A text
    of fewer words is one shingle."""
    size = np.bincount(doc, minlength=count)
    found, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n in range(1, words + 1):
        if len(tokens) < n or (n < words and not (size == n).any()):
            continue
        out = np.zeros(len(tokens) - n + 1, np.uint64)
        for k in range(n):
            out = mixed(out ^ tokens[k : len(tokens) - n + 1 + k], k)
        first = doc[: len(out)]
        whole = first == doc[n - 1 :]
        if n < words:
            whole &= size[first] == n
        found.append(out[whole])
        owner.append(first[whole])
    return np.concatenate(found), np.concatenate(owner)


def cells(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of the units of weight, by document: a shingle that occurs w
    times has w of them, so the weighted Jaccard similarity is that of the cells."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    at = np.arange(len(hashes))
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][: len(at)]
    occurrence = at - np.maximum.accumulate(np.where(new, at, 0)) if len(at) else at
    return mixed(hashes + occurrence.astype(np.uint64) * _GOLDEN, 11), owner


def signatures(units: np.ndarray, owner: np.ndarray, count: int, k: int, wider: int = 1) -> np.ndarray:
    """Name of the earliest dart of each of k coordinates, a row a document.
    Documents without units have zeros."""
    size = np.bincount(owner, minlength=count)
    # With so many darts expected, a coordinate seldom stays empty.
    bound = (wider * (k * log(k) + 4 * k) / np.maximum(size, 1))[owner]
    rank, live, throw = np.zeros(len(units)), np.arange(len(units)), 0
    names, ranks, slots = [], [], []
    while len(live):
        # The next dart of each stream comes an exponential gap later.
        h = mixed(units[live], 101 + throw)
        rank[live] -= np.log((h.astype(np.float64) + 1) * 2.0**-64)
        inside = rank[live] < bound[live]
        live, name = live[inside], mixed(h[inside], 7)
        names.append(name)
        ranks.append(rank[live])
        slots.append(owner[live] * k + (name % np.uint64(k)).astype(np.int64))
        throw += 1
    out, hit = np.zeros(count * k, np.uint64), np.zeros(count * k, bool)
    if names:
        order = np.argsort(-np.concatenate(ranks), kind="stable")
        slot = np.concatenate(slots)[order]
        out[slot] = np.concatenate(names)[order]  # the last write, the earliest dart, stays
        hit[slot] = True
    out = out.reshape(count, k)
    short = np.flatnonzero(~hit.reshape(count, k).all(axis=1) & (size > 0))
    if len(short):
        # Throw further for these: what was earliest stays earliest.
        place = np.full(count, -1)
        place[short] = np.arange(len(short))
        again = place[owner] >= 0
        out[short] = signatures(units[again], place[owner[again]], len(short), k, wider * 2)
    return out


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each ``rows`` coordinates of each signature."""
    out = np.zeros((len(sig), sig.shape[1] // rows), np.uint64)
    for r in range(rows):
        out = mixed(out ^ sig[:, r::rows][:, : out.shape[1]], 31 + r)
    return out.view(np.int64)


_SIGNED = [("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("units", pa.binary()), ("n", pa.int32())]


#: Words of the documents that are signed in one go.
_AT_ONCE = 50_000


def _signed(texts: list[np.ndarray], words: int, k: int, rows: int) -> Iterator[tuple]:
    """Digest, bands and cells of each document; cells of 32 bits tell two texts
    apart well enough to count them."""
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    units, owner = cells(*shingles(np.concatenate(texts), doc, len(texts), words))
    keys = bands(signatures(units, owner, len(texts), k), rows)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    short = (units >> np.uint64(32)).astype("<u4")
    for i, tokens in enumerate(texts):
        own = short[cut[i] : cut[i + 1]]
        digest = blake2b(tokens.tobytes(), digest_size=16).digest()
        yield digest, keys[i].tolist() if len(own) else [], own.tobytes(), len(own)


def _signing(words: int, k: int, rows: int) -> Callable:
    """Replaces the last column, the text, by what is known of it."""

    def run(batches):
        for b in parts(batches):
            found, held, size = [], [], 0
            for tokens in word_hashes(b.column("text"), SPACES):
                held.append(tokens)
                size += len(tokens)
                if size >= _AT_ONCE:
                    found += _signed(held, words, k, rows)
                    held, size = [], 0
            if held:
                found += _signed(held, words, k, rows)
            made = [pa.array([f[c] for f in found], kind) for c, (_, kind) in enumerate(_SIGNED)]
            yield pa.record_batch([*b.columns[:-1], *made], names=[*b.schema.names[:-1], *(n for n, _ in _SIGNED)])

    return run


def _similarity(left: bytes, right: bytes) -> float:
    p, q = np.unique(np.frombuffer(left, "<u4")), np.unique(np.frombuffer(right, "<u4"))
    # Equal neighbours in the merged list are common.
    merged = np.sort(np.concatenate([p, q]), kind="stable")
    common = int((merged[1:] == merged[:-1]).sum())
    return common / (len(merged) - common)


def _checking(least: float) -> Callable:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for b in batches:
            a, z = [], []
            for x, y, left, right in zip(*(b.column(c).to_pylist() for c in ("a", "b", "left", "right")), strict=True):
                if any(_similarity(p, q) >= least for p in left for q in right):
                    a.append(x)
                    z.append(y)
            yield batch(schema, a, z)

    return run


def _fitting(least: float, one: str, other: str) -> Column:
    """Whether two numbers of cells allow the similarity at all."""
    return F.least(one, other) >= F.greatest(one, other) * F.lit(least - 1e-9)


def _verified(pairs: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose similarity is ``least`` or more. Only the cells of
    texts in a pair travel with it."""
    sides = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(True).alias("first")), F.struct(F.col("b").alias("id"), F.lit(False).alias("first")))).alias("side"), "a", "b")
    texts = sides.select("side.id", "side.first", "a", "b").join(signed, "id")
    both = texts.groupBy("a", "b").agg(F.collect_set(F.when(F.col("first"), F.col("units"))).alias("left"), F.collect_set(F.when(~F.col("first"), F.col("units"))).alias("right"))
    return both.mapInArrow(_checking(least), "a long, b long")


_MEETING = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links(rows: list[tuple], least: float) -> Iterator[tuple[int, int]]:
    """Links between members of one bucket (band, id, root, bands, units, member,
    asks) that are in different classes."""
    members, asking = [r for r in rows if r[5]], [r for r in rows if r[6]]
    if not members or not asking:
        return
    band = rows[0][0]
    ids, root = np.array([r[1] for r in members]), np.array([r[2] for r in members])
    earlier = np.array([r[3][:band] for r in members], np.int64).reshape(len(members), band)
    cells_of = [np.frombuffer(r[4], "<u4") for r in members]
    size = np.array([len(c) for c in cells_of])
    for _, x, own_root, own_bands, units, _, _ in asking:
        own = np.sort(np.frombuffer(units, "<u4"))
        fit = (root != own_root) & (np.minimum(size, len(own)) >= np.maximum(size, len(own)) * (least - 1e-9))
        # Texts that share an earlier band too have met there.
        if band:
            fit &= ~(earlier == np.array(own_bands[:band], np.int64)).any(axis=1)
        at = np.flatnonzero(fit)
        if not len(at):
            continue
        theirs = np.concatenate([cells_of[i] for i in at])
        place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
        common = np.add.reduceat(own[place] == theirs, np.r_[0, np.cumsum(size[at])[:-1]], dtype=np.int64)
        near = at[common >= least * (size[at] + len(own) - common)]
        # One link to a class says all.
        _, first = np.unique(root[near], return_index=True)
        for y in ids[near[first]].tolist():
            yield min(x, y), max(x, y)


def _meeting(least: float) -> Callable:
    """Rows come sorted by bucket and block, and a block's rows are bounded."""

    def run(batches):
        held, key = [], None
        for b in batches:
            found = []
            columns = [b.column(c).to_pylist() for c in ("bucket", "i", "q", "band", "id", "root", "bands", "units", "member", "asks")]
            for bucket, i, q, *row in zip(*columns, strict=True):
                here = row[0], bucket, i, q
                if here != key:
                    found += _links(held, least)
                    held, key = [], here
                held.append(row)
            yield batch(_MEETING, [f[0] for f in found], [f[1] for f in found])
        found = list(_links(held, least))
        yield batch(_MEETING, [f[0] for f in found], [f[1] for f in found])

    return run


def _across(named: DataFrame, main: DataFrame, bands: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between the classes of a bucket.

    Members outside the bucket's largest class (``main``) are held against the
    members of all other classes, inside tasks: pairs never become rows, and
    pairs within a class, which can be most of the bucket, are never looked at.
    A large bucket comes in blocks of bounded size on either side.
    """
    at = ["band", "bucket"]
    minor = F.col("root") != F.col("main")
    open_ = named.join(main, at)
    # Blocks are bounded by members and by what these hold: few long texts, or many short ones.
    blocks = lambda some: F.ceil(F.greatest(F.count_if(some) / MEETING, F.sum(F.when(some, F.col("n")).otherwise(0)) / MEETING_CELLS)).cast("int")
    sizes = open_.groupBy(*at).agg(blocks(F.lit(True)).alias("i_n"), blocks(minor).alias("q_n"))
    own_i, own_q = (F.pmod(F.xxhash64("id"), F.col(n)).cast("int") for n in ("i_n", "q_n"))
    span = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # As a member in its own row of blocks, as one that asks in its own column.
    place = lambda i, q: F.struct(i.alias("i"), q.alias("q"), (i == own_i).alias("member"), (minor & (q == own_q)).alias("asks"))
    places = F.flatten(F.transform(span("i_n"), lambda i: F.transform(span("q_n"), lambda q: place(i, q))))
    placed = open_.join(sizes, at).select(*at, "id", "root", F.explode(F.filter(places, lambda p: p["member"] | p["asks"])).alias("p"))
    keys = [*at, "i", "q"]
    rows = placed.select(*at, "id", "root", "p.*").join(signed, "id").join(bands, "id")
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_meeting(least), "a long, b long").distinct()


def components(edges: DataFrame, kept: Scratch) -> DataFrame:
    """(node, root): each node of the links (a, b) with the smallest of its component.

    Large-star and small-star steps in turn: every step links nodes to the
    smallest neighbour, until nothing changes; a logarithmic number of rounds.
    """
    def star(links: DataFrame, large: bool) -> DataFrame:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Smallest of each node's neighbours and itself, then links to it.
        # Stored: a join of two plain tables can split a node with very many links.
        least = kept.stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        joined = both.join(least, "a")
        if large:
            out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            small = joined.where(F.col("b") < F.col("a"))
            out = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return out.where(F.col("a") != F.col("b"))

    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()
    while True:
        links = kept.stored(star(star(links, True), False).distinct(), "stars")
        # Done if each node has one link, to a node that has none.
        ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e"))
        counts = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
        if not counts.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).limit(1).count():
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _apart(every: DataFrame, kept: Scratch) -> DataFrame:
    """``every`` with a number ``id`` for each text of a document: the doc's own, but
    a hash where the table has several texts under one."""
    digests = every.select("doc", F.xxhash64("digest").alias("d")).groupBy("doc").agg(F.min("d").alias("a"), F.max("d").alias("b"))
    several = kept.stored(digests.where("a != b").select("doc"), "ids-of-several-texts")
    if not several.limit(1).count():
        return every.withColumn("id", F.col("doc"))
    some, others = Marks(several, "doc").split(every, F.col("doc"))
    told = some.join(several.withColumn("several", F.lit(True)), "doc", "left")
    own = F.when(F.col("several"), F.xxhash64("doc", "digest")).otherwise(F.col("doc"))
    return kept.stored(told.withColumn("id", own).drop("several").unionByName(others.withColumn("id", F.col("doc"))), "told-apart")


def group_near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    least: float = 0.8,
    coordinates: int = 100,
    band_rows: int = 4,
    keep: Sequence[str] = (),
) -> DataFrame:
    """A row for each row of ``docs``: doc_id, the columns ``keep``, class_id (the
    smallest doc_id of the class), class_size (rows in it), class_key (a number for the class,
    its own even where a repeated id is the smallest of several classes).

    Two texts are linked if the weighted Jaccard similarity of their word
    shingles is ``least`` or more and they share a band; classes are what links
    connect. 25 bands of 4 miss a pair of 0.8 once in half a million. Texts of equal
    words are one class outright. Texts without a word, and null texts, are each a
    class of their own, as are rows with a null id, whose class_id and class_key are null. Rows that
    repeat an id are each in the class of their own text; without words they are one
    class. Whole texts of any length; a task holds the cells of two blocks of bounded size,
    or of one text if that is larger. Other columns are not read.
    """
    spark = docs.sparkSession
    # Numbered names: no name of the input can clash with one that is needed here.
    held = [f"k{i}" for i in range(len(keep))]
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), *(F.col(f"`{c}`").alias(h) for c, h in zip(keep, held, strict=True)), F.col(f"`{text}`").cast("string").alias("text"))
    with scratch(spark) as kept:
        some = own.where(F.col("doc").isNotNull())
        known = T.StructType([*some.schema.fields[:-1], *T.StructType.fromDDL("digest binary, bands array<long>, units binary, n int").fields])
        every = _apart(kept.stored(some.mapInArrow(_signing(words, coordinates, band_rows), known), "signed"), kept)
        kept.sized(every.count(), DOCS_A_FILE)
        # Equal words: the smallest id stands for all. Wordless texts stand for themselves.
        some = every.where(F.col("n") > 0)
        firsts = kept.stored(some.groupBy("digest").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "firsts")
        member = kept.stored(some.select("id", "digest").join(firsts.select("digest", F.col("id").alias("rep")), "digest").select("id", "rep").distinct(), "members")
        placed = firsts.select("id", "n", F.posexplode("bands").alias("band", "bucket"))
        spot = F.xxhash64("band", "bucket")
        heads = kept.stored(
            placed.groupBy("band", "bucket").agg(F.min(F.struct("id", "n")).alias("head"), F.max("id").alias("last")).where(F.col("head.id") != F.col("last")).select("band", "bucket", "head", spot.alias("spot")),
            "heads",
        )
        # Most places hold one text only, and go no further.
        inside = kept.stored(Marks(heads, "spot").within(placed, spot).join(heads.drop("spot"), ["band", "bucket"]), "in-buckets")
        partner = kept.stored(inside.select("id").distinct(), "ids-in-buckets")
        signed = kept.stored(Marks(partner, "id").within(every.select("id", "units"), F.col("id")).join(partner, "id", "left_semi").dropDuplicates(["id"]), "partners")
        pairs = kept.stored(inside.where((F.col("id") != F.col("head.id")) & _fitting(least, "n", "head.n")).select(F.col("head.id").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
        links = kept.stored(_verified(pairs, signed, least), "links")
        roots = components(links, kept)
        # Buckets that still hold several classes.
        named = kept.stored(inside.select("band", "bucket", "id", "n").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")), "named")
        most = F.max(F.struct("count", "root"))
        main = kept.stored(
            named.groupBy("band", "bucket", "root").count().groupBy("band", "bucket").agg(F.count("*").alias("classes"), most.getField("root").alias("main")).where("classes > 1").select("band", "bucket", "main"), "mixed-buckets"
        )
        more = kept.stored(_across(named, main, firsts.select("id", "bands"), signed, least), "more-links")
        if more.limit(1).count():
            roots = components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(more), kept)
        class_of = member.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("id", F.coalesce("root", "rep").alias("root"))
        rows = kept.stored(every.select("doc", *held, "id").join(class_of, "id", "left").withColumn("root", F.coalesce("root", "id")), "rows")
        sizes = kept.stored(rows.groupBy("root").agg(F.min("doc").alias("class_id"), F.count("*").alias("class_size")), "sizes")
        none = own.where(F.col("doc").isNull()).select("doc", *held, F.lit(None).cast("long").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(None).cast("long").alias("root"))
        out = rows.join(sizes, "root").select("doc", *held, "class_id", "class_size", "root").unionByName(none)
        return stored(kept.gathered(out.toDF("doc_id", *keep, "class_id", "class_size", "class_key")), "classes")
