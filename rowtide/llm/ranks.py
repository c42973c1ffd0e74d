"""Ranks inside groups of any size, without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import buckets


def rank_within(df: DataFrame, group: str, order: list[str], rows: int, name: str = "rank") -> DataFrame:
    """``df`` with a rank from 0 inside ``group``.

    The rows of a group are dealt to parts by the hash of ``order``; a rank is the
    number of the group's rows in the parts before, plus the place inside the part.
    ``rows`` bounds the size of the table; it sets the number of parts.
    """
    parts = buckets(rows, 100_000, 1024)
    part: Column = F.pmod(F.xxhash64(*order), F.lit(parts))
    dealt = df.withColumn("__part", part)
    counts = dealt.groupBy(group, "__part").agg(F.count("*").alias("__n"))
    ahead = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(group, "__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order))
    return (
        dealt.join(before, [group, "__part"])
        .withColumn(name, F.col("__before") + inside - 1)
        .drop("__part", "__before")
    )
