"""Quality rules with cross-document line frequency.

One pass over each whole text gives the base measures and the hashes of its
normalised lines (letters A-Z lowered, digit runs as 0, white space runs as one
space, trimmed; blank lines don't count). Documents of a host (source) with the same set of
normalised lines are one document. Per host, the distinct documents with each line are counted; a
line that ``line_docs`` of them have is common, any other is rare.

A common line is boilerplate unless only copies of one article make it common. Documents with
the same rare lines count once, and so do all near copies together. A near copy is a document

* whose common lines hold half of its words or more, and
* whose rare lines are edits of common lines that it lacks, for half of their words or more. A line is an
  edit of another one if what both begin and end with is 70 percent of the longer one's words at least.

So a notice under unrelated articles is boilerplate, however little else they hold and however many
copies of some article are beside them; a copied article is not. A document without rare lines counts as itself. Copies that each add
a line of their own, unlike any common one, can't be told from articles under a notice and count singly.

A document is depleted, and rejected, if boilerplate lines hold more than
``depleted`` percent of its words. The cleaned text is the text without its
boilerplate lines.

Edge cases: a null text has no words and fails the base rules; a null source is a
host of its own; repeated rows are judged alike; a host with fewer than ``line_docs``
documents has no boilerplate; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import WORD, by_batch, key_of, pick, texts, whole_rows, with_texts
from rowtide.session import discard, limits, materialise, release, stored

_WORDS = re.compile(WORD)
_SYMBOLS = "#*$%&|<>"
_DIGITS = re.compile(rb"[0-9]+")
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCAN = (
    "doc_id bigint, host string, content binary, page bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, lines array<struct<line:bigint, words:bigint, seq:binary>>"
)
_LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64()), ("seq", pa.binary())]))


def repeat_words(words: list[str], size: int = 3) -> int:
    """Words inside windows of ``size`` words that the list holds at least twice."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    window = ids[:n]
    for step in range(1, size):
        window = window * len(seen) + ids[step : step + n]
        if step + 1 < size:  # dense again, so that products stay small for any text length
            window = np.unique(window, return_inverse=True)[1]
    _, back, counts = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[back] > 1)
    covered = np.zeros(len(words), bool)
    for step in range(size):
        covered[starts + step] = True
    return int(covered.sum())


def normal_line(words: list[str]) -> bytes:
    return _DIGITS.sub(b"0", " ".join(words).encode("utf-8", "surrogatepass").lower())  # bytes lower A-Z only


def line_hash(words: list[str]) -> str:
    return hashlib.md5(normal_line(words), usedforsecurity=False).hexdigest()[:16]


def line_key(words: list[str]) -> int:
    return int.from_bytes(bytes.fromhex(line_hash(words)), "big", signed=True)


def key_and_sequence(words: list[str]) -> tuple[int, bytes]:
    """The key of a line, and its normalised words as two bytes each."""
    normal = normal_line(words)
    key = int.from_bytes(hashlib.md5(normal, usedforsecurity=False).digest()[:8], "big", signed=True)
    return key, array("H", [crc32(w) & 0xFFFF for w in normal.split(b" ")]).tobytes()


def measures(text: str) -> tuple[tuple[int, int, int, int, int], list[tuple]]:
    """The base measures, and (key, words, sequence) of each different line that has a word."""
    lines = [(line, words) for line in text.split("\n") if (words := _WORDS.findall(line))]
    all_words = [w for _, words in lines for w in words]
    base = (
        len(all_words),
        sum(map(len, all_words)),
        sum(map(text.count, _SYMBOLS)),
        len(lines) - len({line for line, _ in lines}),
        repeat_words(all_words),
    )
    found: dict[int, tuple] = {}
    for _, words in lines:
        key, seq = key_and_sequence(words)
        have = found.get(key)
        found[key] = (key, (have[1] if have else 0) + len(words), seq)
    return base, list(found.values())


def _page(lines: list[tuple]) -> int:
    """A name for the set of a document's lines."""
    keys = b"".join(k.to_bytes(8, "little", signed=True) for k in sorted(line[0] for line in lines))
    return int.from_bytes(hashlib.md5(keys, usedforsecurity=False).digest()[:8], "little", signed=True)


def _scan(batch: pa.RecordBatch) -> pa.RecordBatch:
    cols = {name: [] for name in ("content", "page", *_BASE, "lines")}
    for text in texts(batch):
        cols["content"].append(hashlib.md5(text.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest())
        base, lines = measures(text)
        for name, value in zip(_BASE, base, strict=True):
            cols[name].append(value)
        cols["page"].append(_page(lines))
        cols["lines"].append([dict(zip(("line", "words", "seq"), found, strict=True)) for found in lines])
    kinds = {"content": pa.binary(), "lines": _LINES}
    data = [pa.array(v, kinds.get(k, pa.int64())) for k, v in cols.items()]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), *data], names=["doc_id", "host", *cols])


def scan(docs: DataFrame) -> DataFrame:
    hosted = pick(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), key_of("source").alias("host"), "text"
    )
    return by_batch(hosted, _scan, _SCAN)


_ALIKE = 0.7  # of the longer line's words


def _ends(seq: str) -> Column:
    """Hashes of how a line begins and ends, at the lengths of which two lines that are alike share one.

    Of two such lines, one end that they share is 35 percent of the longer one or more, and the longer one is at most
    1 / 0.7 of the other; so the power of two below 35 percent of the longer one is among those here for both.
    """
    size = f"length({seq}) / 2"
    lengths = [f"CAST(pow(2, 1 + floor(log2(greatest({share} * {size}, 1)))) AS INT)" for share in (_ALIKE / 2, 0.5)]
    keys = [f"xxhash64('{k}', {n}, {e})" for n in lengths for k, e in (("head", f"substring({seq}, 1, {n})"), ("tail", f"substring({seq}, -{n}, {n})"))]
    return F.explode(F.array_distinct(F.array(*[F.expr(k) for k in keys])))


def is_edit(a: bytes, b: bytes) -> bool:
    """Whether two different lines begin and end alike for most of their words."""
    head, tail = (len(os.path.commonprefix(pair)) // 2 for pair in ([a, b], [a[::-1], b[::-1]]))
    short, long = sorted((len(a) // 2, len(b) // 2))
    return min(head + tail, short) >= _ALIKE * long


def _edits(batch: pa.RecordBatch) -> pa.RecordBatch:
    pairs = zip(batch.column("mine").to_pylist(), batch.column("seq").to_pylist(), strict=True)
    kept = batch.filter(pa.array([is_edit(a, b) for a, b in pairs], pa.bool_()))
    sizes = pa.array([len(m) // 2 for m in kept.column("mine").to_pylist()], pa.int64())
    return kept.select(["host", "page", "line", "edit"]).append_column("n", sizes)


def _sent(df: DataFrame) -> DataFrame:
    """A stored table to join with: broadcast if it is within the session's bounds, else left to a shuffle."""
    small = limits(df.sparkSession).may_broadcast(df.count(), df.schema)
    return F.broadcast(df) if small else df.hint("merge")


def boilerplate(lines: DataFrame, scanned: DataFrame, line_docs: int = 10) -> DataFrame:
    """(host, line) of boilerplate.

    ``lines`` has a row per host, page (a distinct document) and line, with its words ``n``; ``scanned`` has the words
    themselves, which travel only for common lines and for documents that may be near copies. Counted in steps,
    each combined before its shuffle.
    """
    common = lines.groupBy("host", "line").agg(F.count("*").alias("docs")).filter(F.col("docs") >= line_docs)
    common = materialise(common.select("host", "line"), "quality-common")
    # Words of common lines; a table of them that is small goes to the lines, not the other way round.
    worded = scanned.select("host", F.explode("lines").alias("l")).select("host", "l.line", "l.seq")
    shared = worded.join(_sent(common), ["host", "line"], "left_semi").groupBy("host", "line").agg(F.any_value("seq").alias("seq"))
    shared = materialise(shared, "quality-shared")
    marked = lines.join(_sent(common.withColumn("shared", F.lit(True))), ["host", "line"], "left")
    has = F.col("shared").isNotNull()
    held = materialise(marked.filter(has).select("host", "page", "line"), "quality-held")
    words = F.col("n")
    own = marked.groupBy("host", "page").agg(
        F.sum(F.when(has, words)).alias("common"),
        F.coalesce(F.sum(F.when(~has, words)), F.lit(0)).alias("rare"),
        F.bit_xor(F.when(~has, F.xxhash64("line"))).alias("own"),
    )
    own = materialise(own.filter("common > 0"), "quality-own")
    # Near copies: most of what is not common are edits of common lines that the document lacks.
    maybe = scanned.join(_sent(own.filter("rare > 0 AND common >= rare").select("host", "page")), ["host", "page"], "left_semi")
    maybe = maybe.groupBy("host", "page").agg(F.any_value("lines").alias("lines"))
    rare = (
        maybe.select("host", "page", F.explode("lines").alias("l"))
        .select("host", "page", "l.line", "l.seq")
        .join(_sent(common), ["host", "line"], "left_anti")
        .select("host", "page", F.col("line").alias("edit"), F.col("seq").alias("mine"), _ends("seq").alias("end"))
    )
    pairs = rare.join(shared.select("host", "line", "seq", _ends("seq").alias("end")), ["host", "end"])
    pairs = pairs.select("host", "page", "line", "edit", "mine", "seq")
    alike = by_batch(pairs, _edits, "host string, page bigint, line bigint, edit bigint, n bigint").distinct()
    alike = alike.join(held, ["host", "page", "line"], "left_anti")
    edits = alike.select("host", "page", "edit", "n").distinct().groupBy("host", "page").agg(F.sum("n").alias("edited"))
    same = F.when(F.col("rare") == 0, F.col("page")).when(2 * F.col("edited") >= F.col("rare"), F.lit(0)).otherwise(F.col("own"))
    kind = F.when(F.col("rare") == 0, 0).when(2 * F.col("edited") >= F.col("rare"), 1).otherwise(2)
    who = own.join(edits, ["host", "page"], "left").select("host", "page", kind.alias("kind"), same.alias("same"))
    per_same = held.join(who, ["host", "page"]).groupBy("host", "line", "kind", "same").agg(F.lit(1).alias("one"))
    per_line = per_same.groupBy("host", "line").agg(F.count("*").alias("different"))
    return per_line.filter(F.col("different") >= line_docs).select("host", "line")


def judge(docs: DataFrame, line_docs: int = 10, depleted: int = 70) -> DataFrame:
    """Per document: doc_id, base measures, base_failed, n_boiler_words, kept, and ``boiler`` (its flagged lines)."""
    scanned, scan_folder = stored(scan(docs), "quality-scan", "zstd")
    rows = materialise(scanned.drop("lines", "page"), "quality-rows")
    sizes = F.transform("lines", lambda x: F.struct(x["line"].alias("line"), (F.length(x["seq"]) / 2).cast("int").alias("n")))
    per_page = scanned.select("host", "page", sizes.alias("lines")).groupBy("host", "page").agg(F.any_value("lines").alias("lines"))
    lines = per_page.select("host", "page", F.inline("lines"))
    lines, lines_folder = stored(lines, "quality-lines", "zstd")
    release(docs.sparkSession)
    flagged = materialise(boilerplate(lines, scanned, line_docs), "quality-flagged")
    each = F.explode(F.transform("lines", lambda x: F.struct(x["line"], x["words"]))).alias("l")
    held = scanned.select("host", "content", each).select("host", "content", "l.*").join(_sent(flagged), ["host", "line"])
    # Equal texts are told once.
    removed = held.groupBy("host", "content", "line").agg(F.max("words").alias("words")).groupBy("host", "content").agg(
        F.sum("words").alias("n_boiler_words"), F.collect_set("line").alias("boiler")
    )
    removed = materialise(removed, "quality-removed")
    for folder in (scan_folder, lines_folder):
        discard(docs.sparkSession, folder)
    release(docs.sparkSession)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost = F.coalesce("n_boiler_words", F.lit(0))
    return (
        rows.join(removed, ["host", "content"], "left")
        .withColumn("n_boiler_words", lost)
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_boiler_words") <= depleted * F.col("n_words")))
    )


def _cleaned(text: str | None, boiler: list[int] | None) -> str | None:
    if not text or not boiler:
        return text
    drop = set(boiler)
    lines = [(line, _WORDS.findall(line)) for line in text.split("\n")]
    return "\n".join(line for line, words in lines if not words or line_key(words) not in drop)


def keep(docs: DataFrame, line_docs: int = 10, depleted: int = 70) -> DataFrame:
    """The documents that pass, all columns, with boilerplate lines removed from the text.

    Further columns may have any name.
    """
    verdict = judge(docs, line_docs, depleted).filter("kept")
    kept = verdict.groupBy("host", "content").agg(F.first("boiler").alias("boiler"))
    content = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).alias("content")
    keyed = whole_rows(docs, "source", "text").select(key_of("source").alias("host"), content, "row")
    return with_texts(keyed.join(kept, ["host", "content"]).select("row", "boiler"), docs, "boiler", _cleaned)
