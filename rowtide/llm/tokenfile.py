"""Token-id files with shuffled planes.

A file holds the ids of whole documents. Blocks of ``block`` ids are transposed into
byte planes (all first bytes, all second bytes, ...) or bit planes; planes that are
zero throughout are left out, the others are compressed with zstandard one by one.

Layout, all numbers little-endian:

    magic               8 bytes, b"RTPLANE1"
    chunks              the compressed planes of each block, one after the other
    documents           doc_ids, then lengths, as 64-bit numbers, zstandard
    chunk index         rows of 64-bit numbers, zstandard: place, ids, planes kept as a
                        bit mask, size of each plane (0 where left out)
    footer              7 64-bit numbers: width (8 for byte planes, 1 for bit planes), block,
                        documents, chunks, places of documents and index, their raw sizes are
                        implied; then the magic again

A reader takes footer and index with two reads and then any chunk on its own.

Documents are written in ascending doc_id order: texts are encoded where they are read, their ids
(two bytes each if the vocabulary allows) go to the file of their range of doc_id and are sorted
there. The ranges come from a pass over the doc_ids alone; a file gets about ``PER_FILE`` documents. Each
task streams its documents to one file and reports its name and counts. Files of failed
attempts are never reported and so never read.

Edge cases: a null text has the end id only; a null doc_id sorts first and is read
back as null; rows that share a doc_id stay apart, ordered by their text; ids need at
most 32 bits; an empty table writes no file and reads back as no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import by_batch, in_arrow, pick, texts
from rowtide.llm.files import new_file, opened, shared_folder
from rowtide.llm.tokens import encoder
from rowtide.session import materialise

MAGIC = b"RTPLANE1"
BLOCK = 65_536
PER_FILE = 100_000  # documents
BYTE, BIT = 8, 1
_NULL = -(1 << 63)
_FOOTER = 7
_MANIFEST = "path string, first_doc bigint, n_docs bigint, n_ids bigint"
_DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def to_planes(ids: np.ndarray, width: int) -> list[bytes]:
    """The planes of a block, lowest first; a zero plane is empty."""
    if width == BYTE:
        rows = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    else:
        bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        rows = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return [row.tobytes() if row.any() else b"" for row in rows]


def from_planes(planes: list[bytes], n: int, width: int) -> np.ndarray:
    if width == BYTE:
        out = np.zeros((n, 4), np.uint8)
        for i, plane in enumerate(planes):
            if plane:
                out[:, i] = np.frombuffer(plane, np.uint8)
        return out.reshape(-1).view("<u4")
    bits = np.zeros((n, 32), np.uint8)
    for i, plane in enumerate(planes):
        if plane:
            bits[:, i] = np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little")
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


class Writer:
    """Streams documents into one file."""

    def __init__(self, address: str, width: int = BYTE, block: int = BLOCK):
        where, path = opened(address)
        self.out = where.open_output_stream(path)
        self.out.write(MAGIC)
        self.place, self.width, self.block = len(MAGIC), width, block
        self.squeeze = zstandard.ZstdCompressor(level=3).compress
        self.held: list[bytes] = []
        self.n_held = 0
        self.index: list[list[int]] = []
        self.doc_ids: list[int] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(_NULL if doc_id is None else doc_id)
        self.lengths.append(len(ids) // 4)
        self.held.append(ids)
        self.n_held += len(ids) // 4
        if self.n_held >= self.block:
            self._flush(everything=False)

    def _flush(self, everything: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        whole = len(ids) if everything else len(ids) // self.block * self.block
        for at in range(0, whole, self.block):
            chunk = ids[at : min(at + self.block, whole)]
            planes = [self.squeeze(p) if p else b"" for p in to_planes(chunk, self.width)]
            kept = sum(1 << i for i, p in enumerate(planes) if p)
            self.index.append([self.place, len(chunk), kept, *map(len, planes)])
            self._write(b"".join(planes))
        self.held = [ids[whole:].tobytes()]
        self.n_held = len(ids) - whole

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.place += len(data)

    def close(self) -> None:
        self._flush(everything=True)
        docs_at = self.place
        self._write(self.squeeze(np.array([self.doc_ids, self.lengths], "<i8").tobytes()))
        index_at = self.place
        self._write(self.squeeze(np.array(self.index, "<i8").tobytes()))
        footer = [self.width, self.block, len(self.doc_ids), len(self.index), docs_at, index_at, self.place]
        self._write(np.array(footer, "<i8").tobytes() + MAGIC)
        self.out.close()


class Reader:
    """Reads footer, documents and index; chunks on demand."""

    def __init__(self, address: str):
        where, path = opened(address)
        self.file = where.open_input_file(path)
        tail = 8 * _FOOTER + len(MAGIC)
        end = self._read(self.file.size() - tail, tail)
        if end[-len(MAGIC) :] != MAGIC:
            raise ValueError(f"{address} is not a complete file of token planes")
        self.width, self.block, docs, chunks, docs_at, index_at, index_end = np.frombuffer(end, "<i8", _FOOTER).tolist()
        self.grow = zstandard.ZstdDecompressor().decompress
        raw = self.grow(self._read(docs_at, index_at - docs_at))
        self.doc_ids, self.lengths = np.frombuffer(raw, "<i8").reshape(2, docs)
        raw = self.grow(self._read(index_at, index_end - index_at))
        self.index = np.frombuffer(raw, "<i8").reshape(chunks, -1) if chunks else np.zeros((0, 3), np.int64)

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def chunk(self, i: int) -> np.ndarray:
        place, n, _, *sizes = self.index[i].tolist()
        data, planes, at = self._read(place, sum(sizes)), [], 0
        for size in sizes:
            planes.append(self.grow(data[at : at + size]) if size else b"")
            at += size
        return from_planes(planes, n, self.width)

    def documents(self) -> Iterator[tuple[int | None, list[np.ndarray]]]:
        """(doc_id, its ids in pieces, each a part of one chunk)."""
        at, ids, next_chunk = 0, np.zeros(0, "<u4"), 0
        for doc_id, length in zip(self.doc_ids.tolist(), self.lengths.tolist(), strict=True):
            pieces, left = [], length
            while left:
                if at == len(ids):
                    at, ids, next_chunk = 0, self.chunk(next_chunk), next_chunk + 1
                piece = ids[at : at + left]
                pieces.append(piece)
                at, left = at + len(piece), left - len(piece)
            yield (None if doc_id == _NULL else doc_id), pieces

    def close(self) -> None:
        self.file.close()


def _cuts(rows: DataFrame) -> np.ndarray:
    """Least doc_id of each file but the first; they only place the cuts."""
    n = rows.count()
    files = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // PER_FILE))
    shares = [i / files for i in range(1, files)]
    if not n or not shares:
        return np.zeros(0, np.int64)
    found = rows.agg(F.percentile_approx("doc_id", shares, F.lit(max(10_000, 10 * files)))).first()[0]
    return np.unique(np.array(found or [], np.int64))


def write(docs: DataFrame, path: str, spaced: bool, end_id: int, width: int = BYTE, block: int = BLOCK) -> DataFrame:
    """Write the files; returns the manifest (path, first_doc, n_docs, n_ids), one row per file."""
    folder = shared_folder(docs.sparkSession, "token-planes")
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    cuts = _cuts(rows.select("doc_id"))

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        code = encoder(path, spaced)
        short = max(code.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        coded = code.encode(texts(batch))
        ids = batch.column("doc_id").fill_null(_NULL).to_numpy()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.searchsorted(cuts, ids, side="right").astype(np.int32)),
                batch.column("doc_id"),
                batch.column("tie"),
                pa.array([short] * len(coded)),
                pa.array([np.frombuffer(c, "<u4").astype("<u2").tobytes() for c in coded] if short else coded, pa.binary()),
            ],
            names=["part", "doc_id", "tie", "short", "ids"],
        )

    coded = by_batch(rows.withColumn("tie", F.xxhash64("text")), encode, "part int, doc_id bigint, tie bigint, short boolean, ids binary")
    ordered = coded.repartitionById(len(cuts) + 1, "part").sortWithinPartitions("part", "doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.uint32(end_id).astype("<u4").tobytes()
        writer, address, n_ids, first = None, "", 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "short", "ids")]
            for doc_id, short, ids in zip(*columns, strict=True):
                if writer is None:
                    address, first = new_file(folder, "planes"), doc_id
                    writer = Writer(address, width, block)
                ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes() if short else ids
                writer.add(doc_id, ids + end)
                n_ids += len(ids) // 4 + 1
        if writer:
            writer.close()
            row = {"path": [address], "first_doc": [first], "n_docs": [len(writer.lengths)], "n_ids": [n_ids]}
            kinds = [("path", pa.string()), *[(c, pa.int64()) for c in ("first_doc", "n_docs", "n_ids")]]
            yield pa.RecordBatch.from_pydict(row, pa.schema(kinds))

    return materialise(in_arrow(ordered.select("doc_id", "short", "ids"), run, _MANIFEST), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it in all files), n_tokens, ids_crc32."""
    ahead = Window.orderBy(F.asc_nulls_first("first_doc")).rowsBetween(Window.unboundedPreceding, -1)
    begun = manifest.select("path", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)).cast("long").alias("before"))
    spread = begun.repartition(max(1, manifest.count()), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist(), strict=True):
                reader, cols, start = Reader(address), [[], [], [], []], before
                for doc_id, pieces in reader.documents():
                    crc = n = 0
                    for piece in pieces:
                        crc, n = zlib.crc32(piece.tobytes(), crc), n + len(piece)
                    for col, v in zip(cols, (doc_id, start, n, crc), strict=True):
                        col.append(v)
                    start += n
                reader.close()
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    return in_arrow(spread, run, _DOCS)
