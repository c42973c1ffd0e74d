"""Dense entity codes in order of first appearance, and cumulative segment ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.operators.lookup import lookup
from rowtide.operators.ordered import OrderedGroups


def factorize(df: DataFrame, entity: str, appearance: Sequence[str], code: str = "cid") -> DataFrame:
    """One row per entity: code from 0, and its number of rows.

    ``appearance`` orders the rows of the whole table uniquely.
    """
    seen = F.min(F.struct(*appearance)) if len(appearance) > 1 else F.min(appearance[0])
    firsts = df.groupBy(entity).agg(seen.alias("__seen"), F.count(F.lit(1)).alias("__rows"))
    groups = OrderedGroups(firsts, [], ["__seen"], derived=True)
    out = groups.scan(row_number="__code")
    return out.select(entity, (F.col("__code") - 1).alias(code), "__rows")


def segment_ends(
    df: DataFrame, entity: str, appearance: Sequence[str], code: str = "cid", end: str = "cus_count"
) -> DataFrame:
    """One row per entity: code, number of rows, and rows up to and including it in code order."""
    seen = F.min(F.struct(*appearance)) if len(appearance) > 1 else F.min(appearance[0])
    firsts = df.groupBy(entity).agg(seen.alias("__seen"), F.count(F.lit(1)).alias("__rows"))
    groups = OrderedGroups(firsts, [], ["__seen"], derived=True)
    out = groups.scan(running={end: F.col("__rows")}, row_number="__code")
    return out.select(entity, (F.col("__code") - 1).alias(code), "__rows", end)


def with_segments(
    df: DataFrame, entity: str, appearance: Sequence[str], code: str = "cid", end: str = "cus_count"
) -> DataFrame:
    """Rows with their entity's code and segment end."""
    ends = segment_ends(df, entity, appearance, code, end)
    return lookup(df, ends, [entity], uses="__rows")
