"""Removing repeated byte strings: each byte of a string of ``length`` bytes that starts earlier too.

Texts that are equal are one class, found by a digest; a later copy repeats all over.
Repeats between different texts go through merged Burrows-Wheeler transforms (``bwt``),
on the stretches that can hold one:

* Anchors. Of the 32-byte strings in every ``length``-byte window, the one with the least
  hash is an anchor. Equal windows have equal anchors at the same place, so a repeat
  lies around an anchor that occurs twice. Texts that share an anchor meet under a
  leader (``routing``).
* Collections. The stretches of a text within reach of the anchors that it shares with a
  leader go to that leader's collection. Collections are merged in batches of bounded
  bytes: shards of a batch are sorted by themselves, their transforms merged, and of
  the suffixes in a repeated interval all but the first in order of (doc_id, start) begin a repeat.
* A collection of more than ``BATCH`` bytes is dealt to several batches by text. Each of these
  also reports the first of each of its strings, and equal ones of different batches
  are matched by two 64-bit hashes, in buckets.

Order is that of doc_id, a null doc_id being last. Edge cases: a null text is empty and
nothing is removed; texts of fewer than ``length`` bytes keep all; rows that share
doc_id and text are one document and have the same result; strings do not run
across documents; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import bwt, routing
from rowtide.llm.common import by_batch, in_arrow, pick, texts
from rowtide.llm.words import mixed
from rowtide.session import discard, limits, materialise, release, stored

GRAM = 32
BATCH = 1 << 18  # bytes of a collection that one merge takes
FLUSH = 1 << 16  # bytes of small collections that share a merge
SHARD = 1 << 14
PER_BUCKET = 1 << 19  # strings of large collections that one task matches
_LAST = (1 << 63) - 1
_STEPS = [np.uint64(0x9E3779B97F4A7C15 + 2 * i) for i in range(8)]
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_SPAN = "digest binary, start bigint, stop bigint"


def anchors(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of the anchors of a text; every window of ``length`` bytes holds one."""
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = _BYTE[raw]
    for i in range(GRAM.bit_length() - 1):
        half = 1 << i
        gram = gram[:-half] * _STEPS[i] + gram[half:]
    gram = mixed(gram)
    window = length - GRAM + 1
    least = _slid(np.minimum, gram, window)
    # A place is an anchor if it has the least hash of any window around it.
    edge = np.zeros(window - 1, np.uint64)
    place = np.flatnonzero(gram == _slid(np.maximum, np.concatenate([edge, least, edge]), window))
    return place, gram[place]


def _slid(fn: np.ufunc, values: np.ndarray, window: int) -> np.ndarray:
    """``fn`` over every ``window`` neighbours."""
    have = 1
    while have < window:
        step = min(have, window - have)
        values = fn(values[:-step], values[step:])
        have += step
    return values


def _scan(docs: DataFrame, length: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[], [], [], [], [], []]
        for text in texts(batch):
            data = text.encode("utf-8", "surrogatepass")
            digest = xxhash.xxh3_128_digest(data)
            _, keys = anchors(np.frombuffer(data, np.uint8), length)
            different = np.unique(keys)
            packed = routing.packed(different, np.zeros(len(different), np.int64), 1)[0]
            node = int.from_bytes(digest[:8], "little", signed=True)
            values = (len(data), digest, node, hashlib.sha256(data).hexdigest(), len(different) < len(keys), packed)
            for col, v in zip(cols, values, strict=True):
                col.append(v)
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
        names = ["n_bytes", "digest", "node", "sha256", "inner", "routes"]
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *names])

    schema = "doc_id bigint, n_bytes bigint, digest binary, node bigint, sha256 string, inner boolean, routes binary"
    return by_batch(docs, run, schema)


def _merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals; those that touch are one."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > stops[:-1]
    first = np.flatnonzero(new)
    return starts[first], stops[np.append(first[1:], len(starts)) - 1]


def _stretches(held: DataFrame, length: int) -> DataFrame:
    """(leader, digest, doc, begins, data): what each text brings to each leader's collection."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[], [], [], [], [], []]
        names = ("digest", "node", "doc", "inner", "met", "text")
        for digest, node, doc, inner, met, text in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            if xxhash.xxh3_128_digest(data) != digest:
                continue
            place, keys = anchors(np.frombuffer(data, np.uint8), length)
            low = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            leaders: dict[int, list] = {}
            for m in met or ():
                leaders.setdefault(m["leader"], []).append(m["low"])
            known, of = np.unique(low, return_inverse=True) if leaders else (low, low)
            spans = {leader: np.isin(known, lows)[of] for leader, lows in leaders.items()}
            if inner:
                _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
                own = times[back] > 1
                spans[node] = spans[node] | own if node in spans else own
            for leader, mine in spans.items():
                at = place[mine]
                a, b = _merged(np.maximum(at - (length - GRAM), 0), np.minimum(at + length, len(data)))
                parts = [data[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                values = (leader, digest, doc, a.astype("<i8").tobytes(), (b - a).astype("<i8").tobytes(), b"".join(parts))
                for col, v in zip(cols, values, strict=True):
                    col.append(v)
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["leader", "digest", "doc", "begins", "sizes", "data"])

    return by_batch(held, run, "leader bigint, digest binary, doc bigint, begins binary, sizes binary, data binary")


def later_windows(rows: list[tuple], length: int) -> tuple[list[tuple[int, int]], list[np.ndarray], list[np.ndarray]]:
    """Of the stretches of a batch: where repeats begin, and where each different string is first.

    ``rows`` are (doc, begins, sizes, data). Returned per stretch, in order: (row, begin in
    the text), starts in the text of windows that also start earlier, starts of first windows.
    """
    stretches, pieces = [], []
    for r, (_, begins, sizes, data) in enumerate(rows):
        at = 0
        for begin, n in zip(begins.tolist(), sizes.tolist(), strict=True):
            stretches.append((r, begin))
            pieces.append(np.frombuffer(data, np.uint8, n, at))
            at += n
    end = np.array([0xFF], np.uint8)  # no byte of a text; strings that run over it are left out below
    shards, owners = [], []
    shard, held = [], 0
    for i, piece in enumerate(pieces):
        shard += [piece, end]
        owners.append((len(shards), held, i))
        held += len(piece) + 1
        if held >= SHARD:
            shards.append(np.concatenate(shard))
            shard, held = [], 0
    if shard:
        shards.append(np.concatenate(shard))
    of, start, interval = bwt.merge(shards, length)
    base = np.concatenate([[0], np.cumsum([len(s) for s in shards])])
    # Place in the whole collection, then stretch and start in the text.
    place = base[of.astype(np.int64)] + start
    heads = np.array([base[s] + at for s, at, _ in owners])
    which = np.searchsorted(heads, place, "right") - 1
    sizes = np.array([len(p) for p in pieces])
    inside = place - heads[which]
    valid = inside + length <= sizes[which]
    which, inside, interval = which[valid], inside[valid], interval[valid]
    if not len(which):
        return stretches, [], []
    docs = np.array([row[0] for row in rows], np.int64)[np.array([r for r, _ in stretches])[which]]
    starts = np.array([b for _, b in stretches])[which] + inside
    # Order of (doc, start) as one number: docs by rank in the batch.
    order = np.unique(docs, return_inverse=True)[1].astype(np.int64) * (1 << 40) + starts
    cuts = np.flatnonzero(np.diff(interval, prepend=interval[0] - 1))
    least = np.repeat(np.minimum.reduceat(order, cuts), np.diff(np.append(cuts, len(order))))
    later = order > least
    by = np.argsort(which, kind="stable")
    bounds = np.searchsorted(which[by], np.arange(len(stretches) + 1))
    out_later, out_first = [], []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
        own = by[a:b]
        out_later.append(np.sort(starts[own][later[own]]))
        out_first.append(np.sort(starts[own][~later[own]]))
    return stretches, out_later, out_first


def window_hashes(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each window of ``length`` bytes."""
    out = []
    for salt in (0, 1):
        gram, have = mixed(_BYTE[raw] + np.uint64(salt)), 1
        whole, done = np.zeros(len(raw) - length + 1, np.uint64), 0
        for bit in range(length.bit_length()):
            if length >> bit & 1:  # lengths of the binary expansion, one after the other
                whole = mixed(whole + np.uint64(done)) + gram[done : done + len(whole)]
                done += have
            if length >> (bit + 1):
                gram, have = mixed(gram[:-have]) + gram[have:], 2 * have
        out.append(mixed(whole))
    return out[0], out[1]


_FIRST = np.dtype([("hash", "<u8"), ("other", "<u8"), ("doc", "<i8"), ("start", "<i8"), ("d1", "<u8"), ("d2", "<u8")])


def _firsts(rows: list[tuple], stretches: list[tuple[int, int]], first: list[np.ndarray], length: int) -> np.ndarray:
    """Entries for the strings that are first in their batch; the whole batch is hashed at once."""
    counts = [len(starts) for starts in first]
    which = np.repeat(np.arange(len(first)), counts)
    out = np.zeros(len(which), _FIRST)
    if not len(which):
        return out
    one, two = window_hashes(np.frombuffer(b"".join(row[4] for row in rows), np.uint8), length)
    sizes = np.concatenate([row[3] for row in rows])
    starts = np.concatenate(first)
    owner, begins = np.array(stretches, np.int64).T
    place = (np.cumsum(sizes) - sizes - begins)[which] + starts
    digests = np.frombuffer(b"".join(row[0] for row in rows), "<u8").reshape(-1, 2)
    of = owner[which]
    out["hash"], out["other"], out["start"] = one[place], two[place], starts
    out["doc"] = np.array([row[1] for row in rows], np.int64)[of]
    out["d1"], out["d2"] = digests[of, 0], digests[of, 1]
    return out


def _found(dealt: DataFrame, length: int, buckets: int) -> DataFrame:
    """Repeats inside batches (digest, start, stop), and the first strings of batches of large collections
    as blobs of entries by bucket (bucket, firsts)."""

    def spans(rows: list[tuple], several: bool) -> Iterator[pa.RecordBatch]:
        stretches, later, first = later_windows([r[1:] for r in rows], length)
        found = []
        for (r, _), mine in zip(stretches, later, strict=False):
            if len(mine):
                found += [(rows[r][0], a, b) for a, b in zip(*[x.tolist() for x in _merged(mine, mine + length)], strict=True)]
        if found:
            yield batch_of(found, [None] * len(found), [None] * len(found))
        entries = _firsts(rows, stretches, first, length) if several else ()
        if len(entries):
            bucket = ((entries["hash"] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            own, cuts = np.unique(bucket[order], return_index=True)
            blobs = [part.tobytes() for part in np.split(entries[order], cuts[1:])]
            yield batch_of([(None, None, None)] * len(own), own.tolist(), blobs)

    def batch_of(found: list[tuple], bucket: list, firsts: list) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = [*zip(*found, strict=True), bucket, firsts]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["digest", "start", "stop", "bucket", "firsts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, group, several = 0, None, False
        names = ("leader", "part", "parts", "digest", "doc", "begins", "sizes", "data")
        for batch in batches:
            for leader, part, parts, digest, doc, begins, sizes, data in zip(
                *[batch.column(c).to_pylist() for c in names], strict=True
            ):
                # Small collections share a merge; a batch of a large one has its own.
                if group != (leader, part) and rows and (held >= FLUSH or several or parts > 1):
                    yield from spans(rows, several)
                    rows, held = [], 0
                group, several = (leader, part), parts > 1
                rows.append((digest, doc, np.frombuffer(begins, "<i8"), np.frombuffer(sizes, "<i8"), data))
                held += len(data)
        if rows:
            yield from spans(rows, several)

    spread = dealt.repartition("leader", "part").sortWithinPartitions("leader", "part")
    schema = "digest binary, start bigint, stop bigint, bucket bigint, firsts binary"
    return in_arrow(spread.select("leader", "part", "parts", "digest", "doc", "begins", "sizes", "data"), run, schema)


def _across(found: DataFrame, length: int, buckets: int) -> DataFrame:
    """(digest, start, stop) of strings that are first in their batch, but later than one of another batch.

    A string has at most one entry per batch, so no bucket is hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [b for batch in batches for b in batch.column("firsts").to_pylist()]
        if not blobs:
            return
        entries = np.frombuffer(b"".join(blobs), _FIRST)
        entries = entries[np.lexsort((entries["start"], entries["doc"], entries["other"], entries["hash"]))]
        same = (entries["hash"][1:] == entries["hash"][:-1]) & (entries["other"][1:] == entries["other"][:-1])
        head = np.flatnonzero(np.concatenate([[True], ~same]))
        first = entries[np.repeat(head, np.diff(np.append(head, len(entries))))]
        later = entries[(entries["doc"] != first["doc"]) | (entries["start"] != first["start"])]
        later = later[np.lexsort((later["start"], later["d2"], later["d1"]))]
        new = np.flatnonzero(np.diff(later["d1"], prepend=later["d1"][:1] + 1) | np.diff(later["d2"], prepend=later["d2"][:1]))
        rows = []
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(later)], strict=True):
            starts = later["start"][a:b]
            digest = later["d1"][a].tobytes() + later["d2"][a].tobytes()
            rows += [(digest, x, y) for x, y in zip(*[v.tolist() for v in _merged(starts, starts + length)], strict=True)]
        if rows:
            kinds = (pa.binary(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["digest", "start", "stop"])

    blobs = found.filter("bucket IS NOT NULL").select("bucket", "firsts").repartition(buckets, "bucket")
    return in_arrow(blobs, run, _SPAN)


def _removed(spans: DataFrame, classes: DataFrame, text: DataFrame) -> DataFrame:
    """Per class: what is left of its first document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[], [], [], []]
        for digest, cuts, text in zip(*[batch.column(c).to_pylist() for c in ("digest", "cuts", "text")], strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            if xxhash.xxh3_128_digest(data) != digest:
                continue
            a, b = _merged(np.array([c["start"] for c in cuts]), np.array([c["stop"] for c in cuts]))
            keep, at = [], 0
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                keep.append(data[at:x])
                at = y
            keep.append(data[at:])
            for col, v in zip(cols, (digest, int((b - a).sum()), len(a), b"".join(keep)), strict=True):
                col.append(v)
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["digest", "removed", "spans", "kept"])

    cuts = spans.groupBy("digest").agg(F.collect_set(F.struct("start", "stop")).alias("cuts"))
    joined = text.join(classes.select("digest", "doc").join(cuts, "digest"), "doc").select("digest", "cuts", "text")
    return by_batch(joined, run, "digest binary, removed bigint, spans bigint, kept binary").dropDuplicates(["digest"])


def _dealt(stretches: DataFrame) -> tuple[DataFrame, int]:
    """Stretches with ``parts`` (batches of their collection) and ``part``; batches of large collections."""
    spark = stretches.sparkSession
    sizes = stretches.groupBy("leader").agg(F.ceil(F.sum(F.length("data")) / BATCH).cast("long").alias("parts"))
    # Only collections of more than a batch have a row, so there are few.
    sizes = materialise(sizes.filter("parts > 1"), "repeats-sizes")
    n, large = sizes.agg(F.count("*"), F.sum("parts")).first()
    sizes = F.broadcast(sizes) if limits(spark).may_broadcast(n, sizes.schema) else sizes
    dealt = stretches.join(sizes, "leader", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    return dealt.withColumn("part", F.pmod(F.xxhash64("digest"), "parts")), large or 0


def _over(spark: SparkSession, folder: str) -> None:
    """A step is over: what was stored for it goes, and so do its shuffle files."""
    discard(spark, folder)
    release(spark)


def strip_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (null: the whole text), sha256 of what is kept."""
    if length % 4 or length < 2 * GRAM:
        raise ValueError(f"length is a multiple of four from {2 * GRAM}")
    spark = docs.sparkSession
    read = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    scanned, folder = stored(_scan(read, length), "repeats-scan")
    rows = materialise(scanned.drop("routes"), "repeats-rows")
    order = F.coalesce("doc_id", F.lit(_LAST))
    classes = rows.groupBy("digest", "node", "inner").agg(F.min(order).alias("doc"))
    classes = materialise(classes, "repeats-classes")
    met, met_folder = stored(routing.led(scanned, routing.buckets_for(scanned), with_keys=True), "repeats-met")
    _over(spark, folder)
    lists = met.groupBy("node").agg(F.collect_list(F.struct("leader", "low")).alias("met"))
    wanted = classes.join(lists, "node", "left").filter("inner OR met IS NOT NULL")
    text = read.select(order.alias("doc"), "text")
    stretches, folder = stored(_stretches(text.join(wanted, "doc"), length), "repeats-stretches")
    _over(spark, met_folder)
    dealt, large = _dealt(stretches)
    buckets = max(16, large * BATCH // PER_BUCKET)
    found, found_folder = stored(_found(dealt, length, buckets), "repeats-found")
    _over(spark, folder)
    spans = found.filter("bucket IS NULL").select("digest", "start", "stop")
    spans, folder = stored(spans.unionByName(_across(found, length, buckets)) if large else spans, "repeats-spans")
    _over(spark, found_folder)
    left = materialise(_removed(spans, classes, text), "repeats-left")
    _over(spark, folder)
    judged = classes.select("digest", "doc").join(left, "digest", "left")
    zero = F.lit(0).cast("long")
    copy = (order != F.col("doc")) & (F.col("n_bytes") >= length)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return rows.join(judged, "digest").select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("removed", zero)).alias("n_removed"),
        F.when(copy, zero + 1).otherwise(F.coalesce("spans", zero)).alias("n_spans"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(copy, none).otherwise(F.coalesce(F.sha2("kept", 256), "sha256")).alias("kept_sha256"),
    )
