"""Left join of a fact table with a unique-keyed table, safe against hot and missing keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.text import name
from rowtide.operators.ordered import left_join_small
from rowtide.session import limits, materialise


def by_row(df: DataFrame, answers: DataFrame, row_id: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Attach long answers (``row_id`` columns, ``at``, ``y``) as columns ``names``, ``at`` being the place in it.

    One aggregation and one join, whatever the number of names. ``row_id`` is unique in ``df``.
    """
    wide = answers.groupBy(*row_id).agg(
        *[F.expr(f"max(CASE WHEN at = {i} THEN y END) AS {name(n)}") for i, n in enumerate(names)]
    )
    wide = wide.withColumnsRenamed({k: f"__r_{k}" for k in row_id})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in row_id]
    return df.join(wide, on, "left").drop(*[f"__r_{k}" for k in row_id])


def lookup(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    *,
    uses: str,
) -> DataFrame:
    """Add the value columns of ``table`` to ``df``; a NULL key matches a NULL key.

    ``table`` is written once and counted. Small: broadcast. Otherwise the keys
    used by very many rows of ``df`` (column ``uses`` of ``table``) are broadcast
    alone and serve their rows without a shuffle. So do rows with a NULL key that
    the table doesn't have. All other rows take a shuffle join.
    """
    lim = limits(df.sparkSession)
    table = materialise(table, "lookup")
    values = [c for c in table.columns if c not in keys and c != uses]
    served_by = table.drop(uses)
    if lim.may_broadcast(table.count(), served_by.schema):
        return left_join_small(df, served_by, keys)

    total = table.agg(F.sum(uses)).first()[0] or 0
    hot_from = max(lim.rows_per_chunk, math.ceil(total / lim.max_chunks))
    hot = table.filter(F.col(uses) > hot_from).select(
        *keys, F.lit(True).alias("__hot"), *[F.col(v).alias(f"__hot_{v}") for v in values]
    )
    cold = table.filter(F.col(uses) <= hot_from).select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], *[F.col(v).alias(f"__cold_{v}") for v in values]
    )
    unkeyed = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    served = F.col("__hot").isNotNull()
    if table.filter(unkeyed).isEmpty():
        served = served | unkeyed
    # Read twice below, so it is written once.
    marked = materialise(left_join_small(df, hot, keys), "lookup-rows")
    done = marked.filter(served).select(*df.columns, *[F.col(f"__hot_{v}").alias(v) for v in values])
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    rest = marked.filter(~served).select(*df.columns).join(cold, on, "left")
    return done.unionByName(rest.select(*df.columns, *[F.col(f"__cold_{v}").alias(v) for v in values]))
