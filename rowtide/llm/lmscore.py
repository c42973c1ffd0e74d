"""Language-model scores: n-gram counts in a log-frequency Bloom filter, smoothed probabilities from probes.

Training counts the grams of one to ``order`` tokens of the training texts and keeps
their quantised counts in a filter (``logbloom``) of ``bits_per_event`` bits an event; exact
counts are kept for single tokens only. A text is a sequence of words, with an end before
and after it. With a gram's level read by probes, ``low`` and ``high`` being the least and the
greatest count of that level,

    p1(t)     = (low(t) + 0.1) / (N + 0.1 (V + 1))
    p2(t|h)   = (low(h t) + prior p1(t)) / (high(h) + prior)        and so on for longer h.

Least counts above, greatest below: probabilities of all tokens after one history sum up
to one at most, whatever the quantisation. What a probe that is wrong adds is as rare as the
filter's error rate. A token's score uses the longest history that its text has.

Work is packed. Texts are read once and stored as batches of tokens, less than two bytes
a token. A batch's different grams travel as sorted numbers, one row for each shard, about three bytes
each; a gram in every text of the corpus is one number in each batch. Shards are sized by
the input, so that a task holds about a million numbers whatever the input.

The filter grows with the corpus. Up to ``spark.rowtide.broadcastBytes`` it is broadcast to the
workers with the exact counts, and batches are scored as they are read. Beyond that the same
probes are made where the shards are: batches ask, each shard answers with a byte a gram, and
answers meet their batch again. A corpus that is scored by its own model asks with the grams that it is
counted by, so they travel once. All ways give the same doubles.

Edge cases: a null, empty or blank text is one token, its end. A row without a doc_id is
held out like one whose id has a checksum of 0; rows with equal ids are texts of their own. Letters A-Z count as
a-z. Without any training text every token has the same probability (base score 0 for each).
An empty table gives an empty result. Other columns are not looked at. Texts of any length are
hashed in pieces of 1 MB that end between words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import in_arrow, pick, texts
from rowtide.llm.logbloom import Filter, filled, floors, joined, shard_of, within_shard
from rowtide.llm.words import mixed, word_hashes
from rowtide.session import limits, release, ship, stored

_STEP = np.uint64(0x9E3779B97F4A7C15)
END = np.uint64(0xE4D5C8A96B7F1023)  # stands for the end of a text; words have hashes of their own
PIECE = 1 << 20  # bytes of text that are hashed at a time
BATCH = 1 << 20  # tokens of a batch; a longer text is a batch of its own
PER_SHARD = 1 << 19  # tokens for each shard: less than a million grams
_SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")


@dataclass(frozen=True)
class Settings:
    order: int = 3
    base: float = 1.25  # of the quantisation
    bits_per_event: int = 12
    hashes: int = 5
    priors: tuple[float, ...] = (40.0, 10.0)  # weight of the shorter history, for two tokens, three, ..
    held_out_of: int = 10


@dataclass(frozen=True)
class Model:
    """A trained model: ``table`` has one row per shard: shard, bits, words, counts."""

    table: DataFrame
    settings: Settings
    shard_bits: int
    tokens: int
    vocabulary: int
    size: int  # bytes of bits, words and counts


def held_out(settings: Settings = Settings()) -> Column:
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return (F.crc32(text) % settings.held_out_of == 0).alias("held_out")


def _pieces(raw: bytes) -> Iterator[bytes]:
    """``raw`` in parts of about ``PIECE`` bytes that end between words."""
    at = 0
    while len(raw) - at > PIECE:
        cut = max(raw.rfind(s, at, at + PIECE) for s in _SPACES)
        if cut < at:  # a word longer than a part
            later = [p for p in (raw.find(s, at + PIECE) for s in _SPACES) if p >= 0]
            cut = min(later, default=len(raw) - 1)
        yield raw[at : cut + 1]
        at = cut + 1
    yield raw[at:]


def _words(group: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, words per text)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in group]
    if sum(map(len, raw)) > PIECE and len(raw) == 1:
        found = [word_hashes(np.frombuffer(p, np.uint8))[1] for p in _pieces(raw[0]) if p]
        words = np.concatenate([*found, np.zeros(0, np.uint64)])
        return words, np.array([len(words)])
    whole = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    starts, words = word_hashes(whole)
    begins = np.cumsum([0, *[len(r) + 1 for r in raw]])
    return words, np.diff(np.searchsorted(starts, begins))


@dataclass
class Batch:
    """Texts as one sequence: an end, then the words and the end of each text."""

    ids: pa.Array
    held: np.ndarray
    tokens: np.ndarray  # per text, with its end
    line: np.ndarray

    @property
    def text_of(self) -> np.ndarray:
        """The text of every token after the first end."""
        return np.repeat(np.arange(len(self.tokens)), self.tokens)

    def grams(self, order: int, chosen: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(tokens of the gram, its places in the line, keys), each gram being named by its last place.

        No gram reaches over an end: an end is only its first or its last token. ``chosen``: texts to use.
        """
        ok = np.ones(len(self.line), bool)
        ok[1:] = True if chosen is None else np.repeat(chosen, self.tokens)
        ok[0] = False
        key, ends = self.line, self.line == END
        yield 1, np.flatnonzero(ok), key[ok]
        for n in range(2, order + 1):
            longer = np.zeros_like(key)
            longer[1:] = mixed(key[:-1] * _STEP + self.line[1:])
            key = longer
            ok[: n - 1] = False
            if n > 2:
                ok[n - 2 :] &= ~ends[: len(ends) - n + 2]
            yield n, np.flatnonzero(ok), key[ok]


def _made(parts: list) -> Batch:
    ids = pa.concat_arrays([p[0] for p in parts])
    counts = np.concatenate([p[3] for p in parts])
    words = np.concatenate([p[2] for p in parts])
    tokens = counts + 1
    line = np.full(int(tokens.sum()) + 1, END, np.uint64)
    ends = np.cumsum(tokens)
    is_word = np.ones(len(line), bool)
    is_word[0] = False
    is_word[ends] = False
    line[is_word] = words
    return Batch(ids, np.concatenate([p[1] for p in parts]), tokens, line)


def batches(source: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    """Texts by the batch, about ``BATCH`` tokens each."""
    kept, size = [], 0
    for rows in (r.slice(i, 512) for r in source for i in range(0, r.num_rows, 512)):
        at = 0
        shown = texts(rows)
        while at < len(shown):
            end, weight = at + 1, len(shown[at])
            while end < len(shown) and weight + len(shown[end]) <= PIECE // 2:
                weight += len(shown[end])
                end += 1
            words, counts = _words(shown[at:end])
            held = rows.column("held_out").slice(at, end - at).to_numpy(zero_copy_only=False).astype(bool)
            kept.append((rows.column("doc_id").slice(at, end - at), held, words, counts))
            size += len(words) + end - at
            at = end
            if size >= BATCH:
                yield _made(kept)
                kept, size = [], 0
    if kept:
        yield _made(kept)


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The place of each key among the different ones in order."""
    order = np.argsort(keys)
    ordered = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]])) if len(keys) else 0
    return out


def _planes(numbers: np.ndarray, kind: str = "<u4") -> bytes:
    """Numbers as planes of bytes, compressed; high bytes are mostly zero."""
    numbers = numbers.astype(kind)
    planes = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _numbers(raw: bytes, kind: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _steps(ascending: np.ndarray) -> bytes:
    """Sorted numbers, as what each adds to the one before."""
    kind = ascending.dtype.type
    return _planes(np.diff(ascending, prepend=kind(0)), ascending.dtype.newbyteorder("<").str)


def _sums(raw: bytes, kind: str = "<u4") -> np.ndarray:
    return np.cumsum(_numbers(raw, kind), dtype=kind)


_LINES = "batch string, size bigint, ids {}, held binary, tokens binary, words binary, line binary"


def _packed(batch: Batch) -> pa.RecordBatch:
    """A batch as one row: its different tokens, most frequent first, and the number of each in the line."""
    different, at, times = np.unique(batch.line, return_inverse=True, return_counts=True)
    by_use = np.argsort(-times, kind="stable")
    place = np.empty(len(by_use), np.uint32)
    place[by_use] = np.arange(len(by_use), dtype=np.uint32)
    return pa.RecordBatch.from_pydict(
        {
            "batch": [uuid.uuid4().hex],
            "size": pa.array([int(batch.tokens.sum())], pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array([0, len(batch.ids)], pa.int32()), batch.ids),
            "held": pa.array([np.packbits(batch.held).tobytes()], pa.binary()),
            "tokens": pa.array([batch.tokens.astype(np.int64).tobytes()], pa.binary()),
            "words": pa.array([different[by_use].tobytes()], pa.binary()),
            "line": pa.array([_planes(place[at])], pa.binary()),
        }
    )


def _unpacked(rows: pa.RecordBatch | pa.Table) -> Iterator[tuple[str, Batch]]:
    for i in range(rows.num_rows):
        row = rows.select(["batch", "held", "tokens", "words", "line"]).slice(i, 1).to_pylist()[0]
        ids = rows["ids"].slice(i, 1)
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        tokens = np.frombuffer(row["tokens"], np.int64)
        held = np.unpackbits(np.frombuffer(row["held"], np.uint8), count=len(tokens)).astype(bool)
        yield row["batch"], Batch(ids.flatten(), held, tokens, np.frombuffer(row["words"], np.uint64)[_numbers(row["line"])])


@dataclass(frozen=True)
class Lines:
    """Texts read into a stored table of batches."""

    table: DataFrame
    settings: Settings
    tokens: int


def read(docs: DataFrame, settings: Settings = Settings()) -> Lines:
    """Texts with the share that is held out, as batches of tokens."""
    rows = pick(docs, "doc_id", "text").select("doc_id", "text", held_out(settings))
    kind = f"array<{rows.schema['doc_id'].dataType.simpleString()}>"

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            yield _packed(batch)

    table, _ = stored(in_arrow(rows, run, _LINES.format(kind)), "lm-lines")
    return Lines(table, settings, table.agg(F.sum("size")).first()[0] or 0)


def _different(keys: np.ndarray) -> np.ndarray:
    """Sorted, each once; for numbers this is faster than a table of hashes."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _sliced(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """(shard, part of sorted keys)."""
    edges = np.searchsorted(shard_of(keys, bits), np.arange((1 << bits) + 1))
    for shard in np.flatnonzero(np.diff(edges)):
        yield int(shard), slice(edges[shard], edges[shard + 1])


_PACKETS = "batch string, shard bigint, words binary, word_n binary, grams binary, gram_n binary"


def _packets(name: str, batch: Batch, order: int, bits: int, learn: bool) -> pa.RecordBatch:
    """The different words and grams of a batch, a row for each shard, with their number in training texts.

    Without ``learn`` they only ask, and have no numbers.
    """
    grams = [k for _, _, k in batch.grams(order)]
    words, keys = _different(grams[0]), _different(np.concatenate(grams))
    seen = list(batch.grams(order, ~batch.held)) if learn else []
    del grams
    word_n = _times(words, seen[0][2]) if learn else None
    gram_n = _times(keys, np.concatenate([k for _, _, k in seen])) if learn else None
    of_words = dict(_sliced(words, bits))
    out = []
    for shard, part in _sliced(keys, bits):
        w = of_words.get(shard, slice(0, 0))
        counts = (_planes(word_n[w]), _planes(gram_n[part])) if learn else (None, None)
        out.append((name, shard, _steps(words[w]), counts[0], _steps(within_shard(keys[part], bits)), counts[1]))
    kinds = [pa.string(), pa.int64(), *[pa.binary()] * 4]
    columns = list(zip(*out, strict=True)) or [()] * 6
    names = [c.split()[0] for c in _PACKETS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _times(different: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How often each of the sorted ``different`` is among ``keys``, which hold no other."""
    found, n = np.unique(keys, return_counts=True)
    out = np.zeros(len(different), np.uint32)
    out[np.searchsorted(different, found)] = n
    return out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    return _runs(keys[order], counts[order])


def _runs(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over equal neighbours."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


_SHARDS = (
    "batch string, shard bigint, bits binary, words binary, counts binary, n_tokens bigint, n_words bigint, levels binary"
)


def _shard_rows(group: pa.Table, settings: Settings, answer: bool) -> pa.Table:
    """A row with the finished shard, and with ``answer`` one for each packet: levels of its grams, counts of its words."""
    packets = group.to_pylist()
    all_words = [_sums(p["words"], "<u8") for p in packets]
    all_grams = [_sums(p["grams"]) for p in packets]
    words, counts = _summed(np.concatenate(all_words), np.concatenate([_numbers(p["word_n"]) for p in packets]).astype(np.int64))
    # Key and count in one number sort faster than keys with their places; a count is below 2**32.
    both = np.concatenate(all_grams).astype(np.uint64) << np.uint64(32) | np.concatenate([_numbers(p["gram_n"]) for p in packets])
    both.sort()
    rest, n = _runs((both >> np.uint64(32)).astype(np.uint32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64))
    del both
    bits = filled(rest[n > 0], n[n > 0], settings.base, settings.bits_per_event, settings.hashes)
    known = counts > 0
    shard = packets[0]["shard"]
    rows = [(None, shard, bits, words[known].tobytes(), counts[known].tobytes(), int(counts.sum()), int(known.sum()), None)]
    if answer:
        levels = joined([(0, bits)], 0, settings.hashes).levels_in(rest, 0)
        for p, w, g in zip(packets, all_words, all_grams, strict=True):
            found = _planes(counts[np.searchsorted(words, w)], "<i8")
            rows.append((p["batch"], shard, None, None, found, None, None, _planes(levels[np.searchsorted(rest, g)], "u1")))
    kinds = [pa.string(), pa.int64(), *[pa.binary()] * 3, pa.int64(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in _SHARDS.split(", ")]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _trained(lines: Lines, answer: bool) -> tuple[Model, DataFrame]:
    """The model, and the answers to its own texts' packets."""
    spark, settings = lines.table.sparkSession, lines.settings
    bits = (lines.tokens // PER_SHARD).bit_length()
    packets = _by_batch(lines, lambda name, batch: _packets(name, batch, settings.order, bits, True), _PACKETS)
    made = packets.groupBy("shard").applyInArrow(lambda group: _shard_rows(group, settings, answer), _SHARDS)
    table, _ = stored(made, "lm-shards")
    release(spark)
    shards = table.filter("batch IS NULL").select("shard", "bits", "words", "counts", "n_tokens", "n_words")
    size = F.sum(F.octet_length("bits") + F.octet_length("words") + F.octet_length("counts"))
    tokens, vocabulary, size = shards.agg(F.sum("n_tokens"), F.sum("n_words"), size).first()
    model = Model(shards, settings, bits, tokens or 0, vocabulary or 0, size or 0)
    return model, table.filter("batch IS NOT NULL").select("batch", "shard", "levels", "counts")


def _by_batch(lines: Lines, fn, schema: str) -> DataFrame:
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in source:
            for name, batch in _unpacked(rows):
                yield fn(name, batch)

    return in_arrow(lines.table, run, schema)


def train(lines: Lines) -> Model:
    """Learn from the texts that are not held out."""
    return _trained(lines, answer=False)[0]


def _probabilities(batch: Batch, model: Model, level_of, count_of) -> dict[str, np.ndarray]:
    """Per text: known tokens, base score and score. ``level_of`` and ``count_of`` take a gram length and its keys."""
    s = model.settings
    least = floors(s.base)
    most = np.concatenate([least[1:] - 1, least[-1:]])
    whole = model.tokens + 0.1 * (model.vocabulary + 1)
    n_texts, text_of = len(batch.tokens), batch.text_of
    level = np.zeros(len(batch.line), np.uint8)  # of the longest gram that is a history so far
    p = np.zeros(len(batch.line))
    for n, place, keys in batch.grams(s.order):
        found = level_of(n, keys)
        if n == 1:
            count = count_of(keys)
            base = np.log10((count + 0.1) / whole)
            p[place] = (least[found] + 0.1) / whole
            level[place] = found
            level[0] = found[-1]  # an end as well
        else:
            before = most[level[place - 1]]
            prior = s.priors[n - 2]
            p[place] = (np.minimum(least[found], before) + prior * p[place]) / (before + prior)
            level = np.zeros(len(batch.line), np.uint8)
            level[place] = found
    return {
        "n_known": np.bincount(text_of, count > 0, n_texts).astype(np.int64),
        "base_score": np.bincount(text_of, base, n_texts),
        "score": np.bincount(text_of, np.log10(p[1:]), n_texts),
    }


def _result(batch: Batch, found: dict[str, np.ndarray], tokens: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch.ids,
            "held_out": pa.array(batch.held),
            "n_tokens": pa.array(batch.tokens, pa.int64()),
            "n_known": pa.array(found["n_known"]),
            "train_tokens": pa.array(np.full(len(batch.tokens), tokens, np.int64)),
            "base_score": pa.array(found["base_score"]),
            "score": pa.array(found["score"]),
        }
    )


def _schema(lines: Lines) -> str:
    kind = lines.table.schema["ids"].dataType.elementType.simpleString()
    return (
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )


def _exact(words: np.ndarray, counts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Counts of ``keys`` by sorted ``words``."""
    if not len(words):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(words, keys), len(words) - 1)
    return np.where(words[at] == keys, counts[at], 0)


def _by_broadcast(lines: Lines, model: Model) -> DataFrame:
    """Every worker holds the whole filter and the exact counts, whose size the caller has checked."""
    shards = [(r.shard, bytes(r.bits), bytes(r.words), bytes(r.counts)) for r in model.table.orderBy("shard").toLocalIterator()]
    held: Broadcast = lines.table.sparkSession.sparkContext.broadcast(shards)
    bits, plain = model.shard_bits, replace(model, table=None)

    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = held.value
        table: Filter = joined([(s, b) for s, b, _, _ in shards], bits, plain.settings.hashes)
        words = np.frombuffer(b"".join(w for _, _, w, _ in shards), np.uint64)  # shards are ranges of the key
        counts = np.frombuffer(b"".join(c for _, _, _, c in shards), np.int64)

        def level_of(n: int, keys: np.ndarray) -> np.ndarray:
            different, back = np.unique(keys, return_inverse=True)
            return table.levels(different)[back]

        for rows in source:
            for _, batch in _unpacked(rows):
                found = _probabilities(batch, plain, level_of, lambda keys: _exact(words, counts, keys))
                yield _result(batch, found, plain.tokens)

    return in_arrow(lines.table, score, _schema(lines))


def _asked(lines: Lines, model: Model) -> DataFrame:
    """What the shards of a model say to packets of other texts."""
    s, bits = model.settings, model.shard_bits
    packets = _by_batch(lines, lambda name, batch: _packets(name, batch, s.order, bits, False), _PACKETS)

    def answer(key: tuple[pa.Scalar, ...], asked: pa.Table, shard: pa.Table) -> pa.Table:
        row = shard.to_pylist()[0] if shard.num_rows else {"bits": b"", "words": b"", "counts": b""}
        table = joined([(0, row["bits"])], 0, s.hashes)
        known, times = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["counts"], np.int64)
        levels = [_planes(table.levels_in(_sums(g), 0), "u1") for g in asked["grams"].to_pylist()]
        counts = [_planes(_exact(known, times, _sums(w, "<u8")), "<i8") for w in asked["words"].to_pylist()]
        return pa.table(
            {
                "batch": asked["batch"],
                "shard": asked["shard"],
                "levels": pa.array(levels, pa.binary()),
                "counts": pa.array(counts, pa.binary()),
            }
        )

    shards = model.table.select("shard", "bits", "words", "counts").groupBy("shard")
    answers = packets.groupBy("shard").cogroup(shards).applyInArrow(answer, "batch string, shard bigint, levels binary, counts binary")
    answers, _ = stored(answers, "lm-answers")
    release(lines.table.sparkSession)
    return answers


def _by_answers(lines: Lines, model: Model, answers: DataFrame) -> DataFrame:
    """Answers meet the batch that asked."""
    plain = replace(model, table=None)

    def score(key: tuple[pa.Scalar, ...], line: pa.Table, answers: pa.Table) -> pa.Table:
        ((_, batch),) = _unpacked(line)
        answers = answers.sort_by("shard")
        levels = np.concatenate([_numbers(x, "u1") for x in answers["levels"].to_pylist()])
        counts = np.concatenate([_numbers(x, "<i8") for x in answers["counts"].to_pylist()])
        grams = [k for _, _, k in batch.grams(plain.settings.order)]
        ends = np.cumsum([0, *map(len, grams)])
        grams = np.concatenate(grams)
        levels = levels[_ranks(grams)]
        del grams
        found = _probabilities(batch, plain, lambda n, k: levels[ends[n - 1] : ends[n]], lambda k: counts[_ranks(k)])
        return pa.Table.from_batches([_result(batch, found, plain.tokens)])

    return lines.table.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, _schema(lines))


def score(lines: Lines, model: Model) -> DataFrame:
    """One row per text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    ship(lines.table.sparkSession)
    if model.size <= limits(lines.table.sparkSession).broadcast_bytes:
        return _by_broadcast(lines, model)
    return _by_answers(lines, model, _asked(lines, model))


def lm_scores(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Train on the texts that are not held out and score all of them."""
    lines = read(docs, settings)
    # A token makes one gram of each length at most; most are there once, and few have more than two events.
    likely = lines.tokens * settings.order * settings.bits_per_event * 2 // 8
    if likely <= limits(docs.sparkSession).broadcast_bytes:
        return score(lines, train(lines))
    model, answers = _trained(lines, answer=True)
    return _by_answers(lines, model, answers)
