"""Reproducible stratified folds and fixed-size samples, ordered by a seeded hash of the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.ordered import OrderedGroups


def seeded(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def stratified_folds(
    df: DataFrame, key: str, target: str, folds: int = 5, seed: int = 42, derived: bool = False
) -> DataFrame:
    """Add ``fold``: within each class the folds differ by at most one row."""
    if "fold" in df.columns:
        raise ValueError("the table already has a column named 'fold'")
    groups = OrderedGroups(df, [target], [seeded(key, seed), F.col(key)], derived=derived)
    placed = groups.scan(row_number="__place")
    return placed.withColumn("fold", F.pmod(F.col("__place") - 1, F.lit(folds)).cast("int")).drop("__place")


def fixed_sample(df: DataFrame, key: str, n: int = 2000, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash; every task keeps at most ``n`` rows."""
    return df.orderBy(seeded(key, seed), key).limit(n)
