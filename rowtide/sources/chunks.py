"""Backfill in chunks that never cut an entity."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.operators.columns import require_parity
from rowtide.session import new_path

_CHUNK = "__chunk_id"


def stage_chunks(df: DataFrame, entity: str, chunks: int = 4, path: str | None = None) -> str:
    """Write the panel laid out by chunk, so that each chunk later reads its own files only."""
    path = path or new_path(df.sparkSession, "chunks")
    if _CHUNK in df.columns:
        raise ValueError(f"the table has a column named {_CHUNK!r}")
    chunk = F.pmod(F.xxhash64(entity), F.lit(chunks)).cast("int")
    # Rows of a chunk come together first, so each chunk is few files however many tasks read the panel.
    laid = df.withColumn(_CHUNK, chunk).repartition(_CHUNK, entity)
    laid.write.mode("overwrite").partitionBy(_CHUNK).parquet(path)
    return path


def iter_chunks(df: DataFrame, entity: str, chunks: int = 4) -> Iterator[DataFrame]:
    """Chunks of whole entities, one after the other."""
    if chunks == 1:
        yield df
        return
    spark, path = df.sparkSession, stage_chunks(df, entity, chunks)
    schema = T.StructType([*df.schema.fields, T.StructField(_CHUNK, T.IntegerType())])
    for i in range(chunks):
        yield spark.read.schema(schema).parquet(path).filter(F.col(_CHUNK) == i).drop(_CHUNK)


def backfill(
    df: DataFrame, entity: str, process: Callable[[DataFrame], DataFrame], chunks: int = 4
) -> DataFrame:
    """Process chunk by chunk; each result is written before the next chunk starts."""
    spark, path = df.sparkSession, new_path(df.sparkSession, "backfill")
    first: DataFrame | None = None
    for part in iter_chunks(df, entity, chunks):
        result = process(part)
        if first is not None:
            require_parity(first, result)
        first = first if first is not None else result
        result.write.mode("append").parquet(path)
    return spark.read.schema(first.schema).parquet(path)
