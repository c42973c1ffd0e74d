"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.session import ship

# ASCII white space as the word contracts state it.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name.

    Other columns may have any name, also one that differs in case only or that
    an operator uses for its own results.
    """
    place = {}
    for i, name in enumerate(df.columns):
        place.setdefault(name, i)
    missing = [n for n in names if n not in place]
    if missing:
        raise ValueError(f"columns {missing} are missing; there are {df.columns}")
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{place[n]}").alias(n) for n in names])


def whole_rows(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, and ``row``: all columns as one struct by position, whatever their names are."""
    place = {}
    for i, name in enumerate(df.columns):
        place.setdefault(name, i)
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_{place[n]}").alias(n) for n in names], F.struct(*plain.columns).alias("row"))


def rows_back(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` out of ``row``."""
    return df.select("row.*").toDF(*like.columns)


def with_texts(df: DataFrame, like: DataFrame, carried: str, fn: Callable[[str | None, object], str | None]) -> DataFrame:
    """The rows of ``df`` (``row`` and ``carried``) as columns of ``like``, their text being fn(text, carried).

    ``n_chars`` follows the text, if there is such a column.
    """
    names = list(like.columns)
    text, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    kind = like.schema.fields[chars].dataType if chars is not None else None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        shown = batch.column(f"_{text}").to_pylist()
        out = [fn(t, c) for t, c in zip(shown, batch.column("__carried").to_pylist(), strict=True)]
        batch = batch.set_column(text, f"_{text}", pa.array(out, pa.string()))
        if chars is not None:
            sizes = pa.array([None if t is None else len(t) for t in out], pa.int64())
            batch = batch.set_column(chars, f"_{chars}", sizes.cast(batch.schema.field(f"_{chars}").type))
        return batch.drop_columns(["__carried"])

    if kind is not None and kind.typeName() not in ("byte", "short", "integer", "long"):
        chars = None
    schema = ", ".join(f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(like.schema.fields))
    return by_batch(df.select("row.*", F.col(carried).alias("__carried")), run, schema).toDF(*names)


def key_of(column: str) -> Column:
    """A string key that also tells null from every value, so that equi-joins keep null groups."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("null"))


def by_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; it may return None for no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):  # bounds what is held beside the batch
                out = fn(batch.slice(start, 512))
                if out is not None and out.num_rows:
                    yield out

    return in_arrow(df, run, schema)


def in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def buckets(rows: int, per_bucket: int, least: int) -> int:
    """How many parts to deal ``rows`` to, so that a part of any one key stays near ``per_bucket`` rows."""
    return max(least, -(-rows // per_bucket))
