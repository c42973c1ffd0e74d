"""Panel scans: missing values unified, time parsed, columns pruned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.calendar import parsed_time
from rowtide.functions.numeric import clean
from rowtide.spec import PanelSpec


def unify_missing(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column."""
    cols = {
        f.name: clean(F.col(f"`{f.name}`")).cast(f.dataType)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(cols) if cols else df


def with_time(df: DataFrame, time: str) -> DataFrame:
    """Parse the time column if it is text."""
    if isinstance(df.schema[time].dataType, T.StringType):
        return df.withColumn(time, parsed_time(F.col(time)))
    return df


def read_panel(
    spark: SparkSession,
    path: str,
    spec: PanelSpec | None = None,
    columns: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """Parquet panel; only the columns of ``spec`` (or ``columns``) reach the scan.

    ``rows`` takes the first rows in the panel's order (entity, then its order; without a ``spec``, the columns in
    turn), so it gives the same rows every time; each task keeps that many at most.
    """
    df = spark.read.parquet(path).drop(*drop)
    wanted = list(columns) if columns is not None else (spec.columns if spec else df.columns)
    order = [spec.entity, *spec.order] if spec else wanted
    df = df.select(*dict.fromkeys([*wanted, *(order if rows is not None else [])]))
    df = unify_missing(df)
    df = with_time(df, spec.time) if spec and spec.time in df.columns else df
    if rows is not None:
        df = df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order]).limit(rows)
    return df.select(*wanted)
