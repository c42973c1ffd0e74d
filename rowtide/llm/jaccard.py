"""Similarity join of documents on word n-grams, by signature trees.

Documents with equal shingle sets form a class, found by a 128-bit digest. Links between
different classes are searched in a forest of signature trees (``sigtree``), which
between them hold every pair that can be linked:

* Routes. All shingles have one order, rare ones first. A link needs a share of a set's own
  shingles in common, so of two linked sets each has a shared one among its first few (all
  but that share, and one more). These are its routes, so common passages are
  routes only of texts that hold little else. How rare a shingle is follows from counts of all sets by
  the shingle's bucket, of which there is a fixed number. Shingles that fall together look
  more frequent than they are; that costs meetings, but any order holds every linked
  pair. Tables of a few documents take the order of the hashes.
* Trees. A set of each route leads it; a leader and all sets on its routes form one
  tree, so all sets of a route meet in a tree. A tree of more than ``block`` sets is dealt
  to subtrees, each with the leader; what they leave apart from the leader meets every
  subtree in a second step, in parts of ``block`` sets, so that a task's memory is bounded.
* Pruning. Chance meetings grow faster than the documents. So before any text moves, bitmaps of all
  sets (thin ones, then wider ones of those left) tell sets apart in the same trees, and only sets that may be
  linked go on.
* Dual traversal inside a tree prunes node pairs by size ranges and greatest possible
  overlap; what remains is verified exactly on the sets.

Links come back as a forest (enough of them to connect each component), and components
from that. Shingles are compared as 64-bit hashes.

Edge cases: a null or blank text has no shingles and links with nothing; a text with
fewer words than a shingle has one; rows with a null doc_id are counted but link with
nothing and have a null component; rows that share a doc_id are one document when it
comes to reaching others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm import routing, sigtree
from rowtide.llm.common import by_batch, in_arrow, pick, rows_back, texts, whole_rows
from rowtide.llm.components import components
from rowtide.llm.words import mixed, shingle_sets
from rowtide.session import discard, limits, materialise, release, stored

BLOCK = 512
_BITMAPS = {"thin": 0.25, "bits": 1, "wide": 4}  # times sigtree.width: thin ones tell unlike sets apart, wide ones similar ones
_SKETCHES = ("thin", "bits")  # of all sets
_C2 = np.uint64(0xC2B2AE3D27D4EB4F)
_BUCKETS, _PIECE = 1 << 22, 1 << 16  # of the counts that order shingles, and those that travel together
_FEW = 4 * BLOCK  # documents that are not worth counting first


def routes(
    hashes: np.ndarray, counts: np.ndarray, num: int, den: int, often: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(route keys, index of the set) for sorted sets laid end to end.

    ``often``: how many sets have a shingle of each bucket; without it shingles are ordered by hash.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    if often is not None:  # stable, so shingles of one count stay in the order of their hashes
        hashes = hashes[np.argsort((owner << 16) | often[_bucket(hashes)], kind="stable")]
    # Of a set that can be linked with a different one: all but what a link needs, and one more.
    first = np.where(counts * den >= num * (counts + 1), counts - -(-counts * num // den) + 1, 0)
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    kept = place < np.repeat(first, counts)
    return mixed(hashes[kept] ^ _C2), owner[kept]


def _digest(part: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(part.tobytes())


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _BUCKETS.bit_length() + 1)).astype(np.int64)


def _often(docs: DataFrame, size: int) -> np.ndarray:
    """How many sets have a shingle of each bucket, up to 65535; a set that repeats in a task counts once there.

    As many numbers as buckets, whatever the rows; few enough for the driver, which broadcasts them.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = np.zeros(_BUCKETS, np.uint32), set()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                hashes, counts = shingle_sets(texts(batch.slice(start, 512)), size)
                fresh = np.zeros(len(counts), bool)
                for i, (e, c) in enumerate(zip(np.cumsum(counts).tolist(), counts.tolist(), strict=True)):
                    if c and (digest := _digest(hashes[e - c : e])) not in seen:
                        seen.add(digest)
                        fresh[i] = True
                np.add.at(held, _bucket(hashes[np.repeat(fresh, counts)]), np.uint32(1))
        yield from pieces(enumerate(held.reshape(-1, _PIECE)))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, at, n in zip(*[batch.column(c).to_pylist() for c in ("piece", "at", "n")], strict=True):
                own = held.setdefault(piece, np.zeros(_PIECE, np.int64))
                own[np.frombuffer(at, "<u2")] += np.frombuffer(n, "<u2")
        yield from pieces(held.items())

    def pieces(found: Iterable[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for piece, counts in found:
            at = np.flatnonzero(counts)
            if len(at):
                n = np.minimum(counts[at], 65535).astype("<u2").tobytes()
                columns = [pa.array([piece], pa.int64()), *[pa.array([x], pa.binary()) for x in (at.astype("<u2").tobytes(), n)]]
                yield pa.RecordBatch.from_arrays(columns, names=["piece", "at", "n"])

    schema = "piece bigint, at binary, n binary"
    dealt = in_arrow(docs.select("text"), counted, schema).repartition(_BUCKETS // _PIECE, "piece")
    out = np.zeros((_BUCKETS // _PIECE, _PIECE), np.uint16)
    for row in in_arrow(dealt, added, schema).toLocalIterator():
        out[row.piece][np.frombuffer(row.at, "<u2")] = np.frombuffer(row.n, "<u2")
    return out.reshape(-1)


def _scan(docs: DataFrame, size: int, num: int, den: int, often: Broadcast | None) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, counts = shingle_sets(texts(batch), size)
        keys, owners = routes(hashes, counts, num, den, often.value if often else None)
        ends = np.cumsum(counts)
        digests = [_digest(hashes[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
        nodes = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(counts),
                pa.array(digests, pa.binary()),
                pa.array(nodes, pa.int64()),
                pa.array(routing.packed(keys, owners, len(counts)), pa.binary()),
                *_maps([hashes[e - c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)], _SKETCHES),
            ],
            names=["doc_id", "n", "digest", "node", "routes", *_SKETCHES],
        )

    schema = f"doc_id bigint, n bigint, digest binary, node bigint, routes binary, {', '.join(f'{b} binary' for b in _SKETCHES)}"
    return by_batch(docs, run, schema)


def _maps(parts: list[np.ndarray], kinds: Iterable[str]) -> list[pa.Array]:
    """Bitmaps of sets, a column for each kind."""
    widths = [sigtree.width(len(p)) for p in parts]
    return [
        pa.array([sigtree.bitmap(p, max(64, int(_BITMAPS[k] * w))).tobytes() for p, w in zip(parts, widths, strict=True)], pa.binary())
        for k in kinds
    ]


_KEPT = 6  # bytes of a shingle's hash that are stored: the high ones, so their order stays


def _short(part: np.ndarray) -> bytes:
    return np.ascontiguousarray(part.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - _KEPT :]).tobytes()


def _tokens(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // _KEPT, 8), np.uint8)
    wide[:, 8 - _KEPT :] = np.frombuffer(raw, np.uint8).reshape(-1, _KEPT)
    return wide.reshape(-1).view("<u8")


_PLACED = "array<struct<leader:bigint,block:bigint>>"


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, digest, rep, placed, n, thin, bits, wide, tokens) of the classes that are in any tree.

    ``wanted`` has node, digest, rep and ``placed``: the blocks of trees that the set meets first, which it
    carries along, so that it needs no join to get there.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, counts = shingle_sets(texts(batch), size)
        ends = np.cumsum(counts).tolist()
        parts = [hashes[e - c : e] for e, c in zip(ends, counts.tolist(), strict=True)]
        right = [d == _digest(p) for d, p in zip(batch.column("digest").to_pylist(), parts, strict=True)]
        out = [batch.column(c) for c in ("node", "digest", "rep", "placed")]
        rows = pa.RecordBatch.from_arrays(
            [
                *out,
                pa.array(counts),
                *_maps(parts, _BITMAPS),
                pa.array([_short(p) for p in parts], pa.binary()),
            ],
            names=["node", "digest", "rep", "placed", "n", *_BITMAPS, "tokens"],
        )
        return rows.filter(pa.array(right))

    # Hinted, so that the plan is the same at every size: texts are shuffled, never collected for a broadcast.
    found = docs.join(wanted.hint("merge"), docs["doc_id"] == wanted["rep"]).select("text", "node", "digest", "rep", "placed")
    schema = f"node bigint, digest binary, rep bigint, placed {_PLACED}, n bigint, {', '.join(f'{b} binary' for b in _BITMAPS)}, tokens binary"
    return by_batch(found, run, schema)


def _joined(members: DataFrame, num: int, den: int) -> DataFrame:
    """Links inside each (leader, block); ``label`` is null or the component known so far."""

    def links(rows: dict[bytes, tuple]) -> Iterator[tuple[int, int]]:
        held = list(rows.values())
        union = sigtree.Union(len(held))
        first: dict[int, int] = {}
        for i, (rep, label, _) in enumerate(held):
            union.join(i, first.setdefault(rep if label is None else label, i))
        for i, j in sigtree.join([t for _, _, t in held], num, den, union):
            yield held[i][0], held[j][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, {}
        names = ("leader", "block", "digest", "rep", "label", "tokens")
        for batch in batches:
            out: list[tuple[int, int]] = []
            for leader, block, digest, rep, label, tokens in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                if group != (leader, block):
                    if len(rows) > 1:
                        out += links(rows)
                    group, rows = (leader, block), {}
                rows[digest] = (rep, label, _tokens(tokens))
            if out:
                yield _pairs(out)
        if len(rows) > 1 and (out := list(links(rows))):
            yield _pairs(out)

    dealt = members.repartition("leader", "block").sortWithinPartitions("leader", "block")
    return in_arrow(dealt.select("leader", "block", "digest", "rep", "label", "tokens"), run, "a bigint, b bigint")


def _by_bitmaps(members: DataFrame, num: int, den: int) -> DataFrame:
    """(leader, block, digest, label) of the sets of each (leader, block) that may be linked with one of another label."""
    names = ("leader", "block", "digest", "label")

    def left(rows: list[tuple]) -> list[tuple]:
        sizes = np.array([r[4] for r in rows], np.int64)
        maps = [np.frombuffer(r[5], np.uint64) for r in rows]
        bits = 64 * min(map(len, maps))
        words = np.stack([sigtree.folded(m, bits) for m in maps])
        labels = np.unique([r[3] for r in rows], return_inverse=True)[1]
        return [r[:4] for r, keep in zip(rows, sigtree.undecided(words, sizes, labels, num, den), strict=True) if keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[batch.column(c).to_pylist() for c in (*names, "n", "bits")], strict=True):
                if rows and rows[-1][:2] != row[:2]:
                    out += left(rows)
                    rows = []
                rows.append(row)
            if out:
                yield batch_of(out)
        if rows and (out := left(rows)):
            yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=list(names))

    dealt = members.repartition("leader", "block").sortWithinPartitions("leader", "block")
    return in_arrow(dealt.select(*names, "n", "bits"), run, "leader bigint, block bigint, digest binary, label bigint")


def _undecided(members: DataFrame, num: int, den: int) -> DataFrame:
    """The sets of each (leader, block) that bitmaps don't tell apart from all other components."""
    return _by_bitmaps(members, num, den)


def _near(members: DataFrame, num: int, den: int) -> DataFrame:
    """(leader, digest) of the sets that bitmaps don't tell apart from all others of some block."""
    return materialise(_by_bitmaps(members, num, den).select("leader", "digest").distinct(), "jaccard-near")


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*links, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _trees(led: DataFrame, block: int) -> DataFrame:
    """(leader, block, blocks, node): the leader is in each block of its tree."""
    sizes = led.groupBy("leader").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks"))
    dealt = led.join(sizes, "leader").select("leader", F.pmod(F.xxhash64("node"), "blocks").alias("block"), "blocks", "node")
    heads = sizes.select("leader", _every_block(), "blocks", F.col("leader").alias("node"))
    return dealt.unionByName(heads)


def _every_block() -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")


def _open(trees: DataFrame, block: int) -> DataFrame:
    """(leader, block, digest, label) of the trees whose sets are not all connected, as they meet.

    What is apart from the leader meets every block of its tree: it is dealt to parts of some ``block`` sets, and
    each part meets each block, so that no meeting grows with the tree. Blocks are numbered by block and part.
    """
    open_ = trees.groupBy("leader").agg(
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.min(F.when(F.col("node") == F.col("leader"), F.col("label"))).alias("head"),
    )
    left = trees.join(open_.filter("low < high").select("leader", "head"), "leader")
    apart = F.coalesce(F.col("label") != F.col("head"), F.lit(False))
    left = materialise(left.select("leader", "block", "blocks", "digest", "label", apart.alias("apart")), "jaccard-open")
    parts = left.filter("apart").groupBy("leader").agg(F.ceil(F.count("*") / block).cast("long").alias("parts"))
    dealt = left.join(parts, "leader")
    here = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda p: F.col("block") * F.col("parts") + p)
    part = F.pmod(F.xxhash64("digest", "leader"), "parts")
    there = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: b * F.col("parts") + part)
    meets = F.when(F.col("apart"), F.array_union(here, there)).otherwise(here)
    return dealt.select("leader", F.explode(meets).alias("block"), "digest", "label")


def _pruned(led: DataFrame, sketches: DataFrame, bits: str, num: int, den: int, block: int) -> DataFrame:
    """``led`` with the sets that may be linked with another one of their tree, as far as bitmaps tell.

    A set meets its block first. What is apart from all of it meets the tree's other blocks as in ``_open``. The
    least of the sets that are left leads them, so every pair that may be linked still shares a leader.
    """
    spark = led.sparkSession
    maps = sketches.select("node", "digest", "n", F.col(bits).alias("bits"))
    trees = materialise(_trees(led, block), "jaccard-trees")
    met = trees.join(maps.hint("merge"), "node").withColumn("label", F.xxhash64("digest"))
    near = _near(met, num, den)
    large = trees.filter("blocks > 1")
    if not large.isEmpty():
        held = large.join(sketches.select("node", "digest").hint("merge"), "node")
        held = held.join(near.withColumn("near", F.lit(True)), ["leader", "digest"], "left")
        # Sets that go on anyway need not meet each other; their leader has met the whole tree.
        known = F.col("near").isNotNull() | (F.col("node") == F.col("leader"))
        held = held.withColumn("label", F.when(known, F.col("leader")).otherwise(F.xxhash64("digest")))
        left = materialise(_open(held, block), "jaccard-meetings")
        near = near.unionByName(_near(left.join(maps.drop("node").hint("merge"), "digest"), num, den))
    left = near.distinct().join(sketches.select("digest", "node").hint("merge"), "digest").select("leader", "node")
    heads = left.groupBy("leader").agg(F.min("node").alias("head"))
    out = left.join(heads, "leader").filter("node != head").select(F.col("head").alias("leader"), "node").distinct()
    out = materialise(out, "jaccard-led")
    release(spark)
    return out


def _needed(sets: DataFrame, members: DataFrame) -> DataFrame:
    """The sets of ``members`` (a stored table); as far as their digests may be broadcast, the others are not shuffled."""
    digests = materialise(members.select("digest").distinct(), "jaccard-needed")
    if limits(sets.sparkSession).may_broadcast(digests.count(), digests.schema):
        sets = sets.join(F.broadcast(digests), "digest", "left_semi")
    return sets


def _links(docs: DataFrame, classes: DataFrame, led: DataFrame, size: int, num: int, den: int, block: int) -> DataFrame:
    """Links enough to connect every component, in two steps.

    First each set meets the tree of its least leader, which connects nearly all near
    copies. Then only trees whose sets are not all connected are left, and in them only
    pairs of different components. Joins with sets are hinted: at any size they are
    merge joins, and no set is broadcast.
    """
    nodes = led.select("node").union(led.select("leader")).distinct()
    wanted = classes.filter(F.col("rep").isNotNull()).join(nodes, "node", "left_semi")
    least = led.groupBy("node").agg(F.min("leader").alias("leader"))
    placed = _trees(least, block).groupBy("node").agg(F.collect_list(F.struct("leader", "block")).alias("placed"))
    wanted = wanted.join(placed.hint("merge"), "node", "left").withColumn("placed", F.col("placed").cast(_PLACED))
    sets, folder = stored(_sets(docs, wanted, size), "jaccard-sets")
    del wanted, placed, nodes
    release(docs.sparkSession)  # the texts' way to their sets is over
    members = sets.select(F.inline("placed"), "digest", "rep", F.lit(None).cast("long").alias("label"), "tokens")
    first = materialise(_joined(members, num, den), "jaccard-links")
    del members
    release(docs.sparkSession)

    known = components(first).select(F.col("v").alias("rep"), F.col("p").alias("label"))
    named = sets.select("node", "digest", "rep").join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    trees = _trees(led, block).join(materialise(named, "jaccard-named"), "node")
    trees = materialise(trees.drop("rep"), "jaccard-trees")
    left = materialise(_open(trees, block), "jaccard-meetings")
    release(docs.sparkSession)
    # Bitmaps are a fraction of the sets; thin ones, then wider ones, settle most of what near copies
    # of different groups leave open.
    again = None
    for bits in _BITMAPS:
        maps = (sets if again is None else _needed(sets, again)).select("digest", "n", F.col(bits).alias("bits")).hint("merge")
        mapped = (left if again is None else again).join(maps, "digest")
        again = materialise(_undecided(mapped, num, den), "jaccard-undecided")
        del mapped, maps
        release(docs.sparkSession)
    again = again.join(_needed(sets, again).select("digest", "rep", "tokens").hint("merge"), "digest")
    last = materialise(_joined(again, num, den), "jaccard-links")
    discard(docs.sparkSession, folder)
    release(docs.sparkSession)
    return first.unionByName(last)


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the least doc_id reachable by links).

    Two documents are linked if 100 * common >= percent * all of their ``words``-word shingles.
    """
    spark = docs.sparkSession
    num, den = percent, 100
    read = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    often = None
    if read.count() > _FEW:
        often = spark.sparkContext.broadcast(_often(read, words))
        release(spark)
    scanned, folder = stored(_scan(read, words, num, den, often), "jaccard-scan")
    if often:
        often.unpersist()
    rows = materialise(scanned.drop("routes", *_SKETCHES), "jaccard-rows")
    same = [F.first(c).alias(c) for c in ("n", *_SKETCHES)]
    sketches = scanned.filter("n > 0").groupBy("digest", "node").agg(F.min("doc_id").alias("rep"), *same)
    sketches, sketched = stored(sketches, "jaccard-sketches")
    classes = materialise(sketches.select("digest", "node", "rep"), "jaccard-classes")
    named = scanned.filter("doc_id IS NOT NULL")  # so every leader has a document
    led = materialise(routing.led(named, routing.buckets_for(named)), "jaccard-led")
    discard(spark, folder)
    release(spark)
    for bits in _SKETCHES:
        led = _pruned(led, sketches, bits, num, den, block)
    discard(spark, sketched)
    links = _links(read, classes, led, words, num, den, block)
    placed = materialise(rows.filter("n > 0").join(classes.select("digest", "rep"), "digest").select("doc_id", "n", "rep"), "jaccard-reps")
    # A doc_id whose rows differ in text joins the classes of all of them.
    several = placed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("x")).filter("a < x")
    same_id = placed.join(several, "doc_id").select("a", F.col("rep").alias("b"))
    found = components(links.unionByName(same_id)).select(F.col("v").alias("rep"), F.col("p").alias("label"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "rep"))
    linked = placed.join(found, "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
    blank = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(blank)


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates (the one with the least doc_id, null last), all columns.

    Rows are told apart by doc_id and text: equal ones are one document, also without a doc_id, and rows that share
    a doc_id but not their text are documents of their own. Further columns may have any name.
    """
    rows = whole_rows(docs, "doc_id", "text")
    name = F.xxhash64("doc_id", "text")
    found = jaccard_components(rows.select(name.alias("doc_id"), "text"), words, percent)
    groups = found.select(F.col("doc_id").alias("name"), F.col("component_id").alias("group")).distinct()
    ids = rows.select(name.alias("name"), F.col("doc_id").cast("long").alias("doc_id")).distinct()
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "name")
    stay = ids.join(groups.hint("merge"), "name").groupBy("group").agg(F.min(order)["name"].alias("name")).select("name")
    some = rows.select(name.alias("name"), "row").join(stay, "name", "left_semi").dropDuplicates(["name"])
    return rows_back(some, docs)
