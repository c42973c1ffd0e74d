"""Ranks and standardising over huge groups (categories or the whole table).

Ranks are computed on distinct values with their counts, so ties and hot values are combined
before the shuffle, and the ranked values are looked up. One column is looked up by its rows as
they are. Several go through together: cells are laid out as (row, column, value), so the
number of passes does not depend on the number of columns, and one aggregation brings them back
to rows. ``row_id`` names columns that identify a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.numeric import ratio
from rowtide.operators.lookup import by_row, lookup
from rowtide.operators.ordered import OrderedGroups
from rowtide.session import materialise


def _cells(df: DataFrame, row_id: Sequence[str], cells: Sequence[Column]) -> DataFrame:
    """(row id, at, group, value) of every valued cell; ``cells`` are structs (group, value)."""
    each = df.select(*row_id, F.posexplode(F.array(*cells)).alias("at", "cell"))
    flat = each.select(*row_id, "at", "cell.group", "cell.value").filter("value IS NOT NULL")
    return materialise(flat, "cells")


def _cell(group: Column, value: str) -> Column:
    return F.struct(group.cast("string").alias("group"), F.col(value).cast("double").alias("value"))


def _rank_table(cells: DataFrame, keys: Sequence[str], of: Column) -> DataFrame:
    """``keys``, value, ``y``: the average rank of each different value in its group, divided by ``of``."""
    ties = cells.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("__ties"))
    ranked = OrderedGroups(ties, keys, ["value"], derived=True).scan(
        running={"__upto": F.col("__ties")}, sums={"__valued": F.col("__ties")}
    )
    rank = F.col("__upto") - (F.col("__ties") - 1) / 2.0
    return ranked.select(*keys, "value", F.col("__ties").alias("__uses"), ratio(rank, of).alias("y"))


def _ranks(cells: DataFrame, of: Column) -> DataFrame:
    """Each cell's average rank in (at, group), divided by ``of``, as ``y``."""
    table = _rank_table(cells, ["at", "group"], of)
    return lookup(cells, table, ["at", "group", "value"], uses="__uses")


def _one(df: DataFrame, value: str, group: Column | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """(rows with ``__value`` and ``__group``, their valued cells, the groups' keys) of one column."""
    rows = df.withColumn("__value", F.col(value).cast("double"))
    cells, keys = F.col("__value").isNotNull(), []
    if group is not None:
        rows, keys = rows.withColumn("__group", group), ["__group"]
        cells &= F.col("__group").isNotNull()
    return rows, rows.filter(cells).select(*keys, F.col("__value").alias("value")), keys


def _looked_up(rows: DataFrame, table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    out = lookup(rows, table.withColumnRenamed("value", "__value"), keys, uses="__uses")
    return out.withColumnRenamed("y", name).drop("__value", "__group")


def rank_by_category(
    df: DataFrame, values: Sequence[str], categories: Sequence[str], row_id: Sequence[str]
) -> DataFrame:
    """``{f}_pct_rank_by_{c}``: average-method rank within the category / non-missing count."""
    pairs = [(f, c) for c in categories for f in values]
    if len(pairs) == 1:
        ((f, c),) = pairs
        rows, cells, keys = _one(df, f, F.col(c))
        return _looked_up(rows, _rank_table(cells, keys, F.col("__valued")), [*keys, "__value"], f"{f}_pct_rank_by_{c}")
    cells = _cells(df, row_id, [_cell(F.col(c), f) for f, c in pairs]).filter(F.col("group").isNotNull())
    ranked = _ranks(cells, F.col("__valued"))
    return by_row(df, ranked, row_id, [f"{f}_pct_rank_by_{c}" for f, c in pairs])


def global_rank(df: DataFrame, values: Sequence[str], row_id: Sequence[str]) -> DataFrame:
    """``{f}_global_rank``: average-method rank over the table / number of rows."""
    if len(values) == 1:
        rows, cells, keys = _one(df, values[0], None)
        return _looked_up(rows, _rank_table(cells, keys, F.lit(df.count())), ["__value"], f"{values[0]}_global_rank")
    cells = _cells(df, row_id, [_cell(F.lit("all"), f) for f in values])
    ranked = _ranks(cells, F.lit(df.count()))
    return by_row(df, ranked, row_id, [f"{f}_global_rank" for f in values])


def standardise_by_category(
    df: DataFrame, values: Sequence[str], categories: Sequence[str], row_id: Sequence[str]
) -> DataFrame:
    """``{f}_standardized_by_{c}``: distance from the category mean in sample standard deviations."""
    pairs = [(f, c) for c in categories for f in values]
    moments = (F.count(F.lit(1)).alias("__uses"), F.avg("value").alias("__avg"), F.stddev_samp("value").alias("__std"))
    if len(pairs) == 1:
        ((f, c),) = pairs
        rows, cells, keys = _one(df, f, F.col(c))
        seen = lookup(rows, cells.groupBy(*keys).agg(*moments), keys, uses="__uses")
        y = ratio(F.col("__value") - F.col("__avg"), F.col("__std"))
        return seen.withColumn(f"{f}_standardized_by_{c}", y).drop("__value", "__group", "__avg", "__std")
    cells = _cells(df, row_id, [_cell(F.col(c), f) for f, c in pairs]).filter(F.col("group").isNotNull())
    table = cells.groupBy("at", "group").agg(*moments)
    seen = lookup(cells, table, ["at", "group"], uses="__uses")
    scored = seen.withColumn("y", ratio(F.col("value") - F.col("__avg"), F.col("__std")))
    return by_row(df, scored, row_id, [f"{f}_standardized_by_{c}" for f, c in pairs])
