"""One-hot encoding with a fitted, saveable category table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.text import name, quoted
from rowtide.operators.ordered import OrderedGroups

MAX_COLUMNS = 10_000


def fit_one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Category table (column, value, position); position 0 is the dropped one.

    Numeric codes sort as numbers. Distinct values are combined before the
    shuffle, so the positions are computed on one row per category.
    """
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
        )
    ).alias("p")
    is_text = {c: dict(df.dtypes)[c] == "string" for c in columns}
    number = F.when(
        F.col("column").isin([c for c in columns if not is_text[c]]), F.col("value").try_cast("double")
    )
    seen = df.select(pairs).select("p.*").filter("value IS NOT NULL").distinct()
    ranked = OrderedGroups(seen, ["column"], [number, "value"], derived=True).scan(row_number="__r")
    return ranked.select("column", "value", (F.col("__r") - 1).cast("int").alias("position"))


def apply_one_hot(df: DataFrame, categories: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace ``columns`` by ``{c}_{value}`` flags; unknown and missing categories give all zeros.

    The category table becomes output columns, so it is small or the encoding
    itself makes no sense; that is checked.
    """
    rows = categories.filter("position > 0").limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"one-hot encoding would add more than {MAX_COLUMNS} columns")
    order = {c: i for i, c in enumerate(columns)}
    rows = sorted((r for r in rows if r["column"] in order), key=lambda r: (order[r["column"]], r["position"]))
    flags = [
        f"CASE WHEN CAST({name(r['column'])} AS STRING) = {quoted(r['value'])} THEN 1 ELSE 0 END "
        f"AS {name(r['column'] + '_' + r['value'])}"
        for r in rows
    ]
    kept = [c for c in df.columns if c not in order]
    names = kept + [f"{r['column']}_{r['value']}" for r in rows]
    again = sorted({n for n in names if names.count(n) > 1}) if len(set(names)) < len(names) else []
    if again:
        raise ValueError(f"duplicate output columns: {again}")
    return df.selectExpr(*[name(c) for c in kept], *flags)


def save_categories(categories: DataFrame, path: str) -> None:
    categories.write.mode("overwrite").parquet(path)


def load_categories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("column string, value string, position int").parquet(path)
