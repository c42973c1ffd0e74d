"""Token counts from flat, unindexed token files by a separator scan.

A flat file is nothing but ids of one width; each document ends with the separator
id. Files are cut into blocks at id boundaries, so that a file of any size is scanned
by many tasks. A task looks for the separator in a block with one vectorised compare.
A prefix scan over the blocks of a file then carries two numbers into each block: the
separators before it and the place of the last one, which is where the document that
runs into the block began.

Edge cases: ids after a file's last separator are a document that is not terminated;
an empty file has no documents; a block without a separator belongs to the document
that runs through it; bytes short of an id at the end of a file raise an error. When
flat files are written from documents, a null text is the separator alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.llm.common import in_arrow, pick, texts
from rowtide.llm.files import new_file, opened, shared_folder
from rowtide.llm.tokens import encoder
from rowtide.session import materialise

WIDTH = 2
BLOCK_IDS = 2_097_152


def write_flat(docs: DataFrame, path: str, spaced: bool, separator: int, width: int = WIDTH) -> tuple[str, DataFrame]:
    """Write documents as flat files: their folder, and (file, ordinal, doc_id), which the files don't hold."""
    folder = shared_folder(docs.sparkSession, "flat-tokens")
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = f"<u{width}"
        out, address, ordinal = None, "", 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                if out is None:
                    address = new_file(folder, "ids")
                    where, name = opened(address)
                    out = where.open_output_stream(name)
                for ids in encoder(path, spaced, ordinary=True).encode(texts(part)):
                    out.write(np.frombuffer(ids, "<u4").astype(kind).tobytes() + np.array([separator], kind).tobytes())
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([address] * n, pa.string()),
                        pa.array(np.arange(ordinal, ordinal + n)),
                        part.column("doc_id"),
                    ],
                    names=["file", "ordinal", "doc_id"],
                )
                ordinal += n
        if out:
            out.close()

    return folder, materialise(in_arrow(rows, run, "file string, ordinal bigint, doc_id bigint"), "flat-order")


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder with their lengths in bytes; their content is not read."""
    return spark.read.format("binaryFile").load(folder).select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def count_tokens(files: DataFrame, separator: int, width: int = WIDTH, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Per document of each file: file, ordinal, start, n_tokens (without the separator), terminated.

    ``files`` has file (address) and bytes.
    """
    step = block_ids * width
    blocks = files.filter("bytes > 0").select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(step).cast("long"))).alias("at")
    )
    spread = blocks.repartition(F.col("file"), F.col("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, at in zip(*[batch.column(c).to_pylist() for c in ("file", "bytes", "at")], strict=True):
                if size % width:
                    raise ValueError(f"{file}: {size} bytes are not whole ids of {width} bytes")
                where, name = opened(file)
                with where.open_input_file(name) as source:
                    source.seek(at)
                    ids = np.frombuffer(source.read(step), f"<u{width}")
                found = np.flatnonzero(ids == separator) + at // width
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file], pa.string()),
                        pa.array([at // width], pa.int64()),
                        pa.array([at // width + len(ids)], pa.int64()),
                        pa.array([size // width], pa.int64()),
                        pa.array([found], pa.list_(pa.int64())),
                    ],
                    names=["file", "first", "stop", "ids", "found"],
                )

    schema = "file string, first bigint, stop bigint, ids bigint, found array<bigint>"
    scanned = materialise(in_arrow(spread, run, schema), "flat-blocks")
    before = Window.partitionBy("file").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    carried = scanned.select("file", "first", F.size("found").alias("n"), F.try_element_at("found", F.lit(-1)).alias("last")).select(
        "file",
        "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("documents"),
        (F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1)) + 1).alias("open"),
    )
    joined = scanned.join(carried, ["file", "first"])
    # The last block also closes a document that has no separator.
    begin = F.coalesce(F.try_element_at("found", F.lit(-1)) + 1, F.col("open"))
    rest = (F.col("stop") == F.col("ids")) & (begin < F.col("ids"))
    ends = F.when(rest, F.concat("found", F.array("ids"))).otherwise(F.col("found"))
    starts = F.concat(F.array("open"), F.transform("ends", lambda e: e + 1))
    pairs = F.arrays_zip(F.slice("starts", 1, F.size("ends")).alias("start"), F.col("ends").alias("end"))
    each = (
        joined.withColumn("ends", ends)
        .withColumn("starts", starts)
        .select("file", "documents", "ids", F.posexplode(pairs).alias("i", "d"))
    )
    return each.select(
        "file",
        (F.col("documents") + F.col("i")).cast("long").alias("ordinal"),
        F.col("d")["start"].cast("long").alias("start"),
        (F.col("d")["end"] - F.col("d")["start"]).cast("long").alias("n_tokens"),
        (F.col("d")["end"] < F.col("ids")).alias("terminated"),
    )
