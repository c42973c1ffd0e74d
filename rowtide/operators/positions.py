"""Row positions within an entity: from the start, from the end, and by time rank with ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.functions.text import name
from rowtide.operators.lookup import lookup
from rowtide.operators.ordered import OrderedGroups
from rowtide.session import materialise
from rowtide.spec import PanelSpec

RN = "__rn"
N = "__n"
MAX_COLUMNS = 10_000


def with_ordinals(df: DataFrame, spec: PanelSpec, **totals: Column) -> DataFrame:
    """Add the 1-based position, the entity's row count, and any further entity aggregates."""
    groups = OrderedGroups(df, [spec.entity], spec.order)
    return groups.scan(sums={N: F.lit(1).cast("long")}, totals=totals, row_number=RN)


def with_time_ranks(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add size, average-method rank of time, reverse position and running count per tied time.

    ``statement`` is 0 for the latest time. Rows without a time have no rank.
    """
    entity, time = spec.entity, spec.time
    groups = OrderedGroups(df, [entity], spec.order)
    ranked = groups.scan(
        sums={N: F.lit(1).cast("long"), "__untimed": F.col(time).isNull().cast("long")},
        totals={"max_time": F.max(time)},
        row_number=RN,
    )
    if groups.is_split:
        ranked = materialise(ranked, "ranked")
        ties = ranked.groupBy(entity, time).agg(
            F.min(RN).alias("__tie_start"), F.count(F.lit(1)).alias("__ties")
        )
        ties = ties.filter(F.col(time).isNotNull()).withColumn("__uses", F.col("__ties"))
        ranked = lookup(ranked, ties, [entity, time], uses="__uses")
    else:
        tied = Window.partitionBy(entity, time)
        ranked = ranked.withColumns(
            {"__tie_start": F.min(RN).over(tied), "__ties": F.count(F.lit(1)).over(tied)}
        )
    timed = F.col(time).isNotNull()
    rank = F.col("__tie_start") - F.col("__untimed") + (F.col("__ties") - 1) / 2.0
    return ranked.withColumns(
        {
            "size": F.col(N),
            "time_rank": F.when(timed, rank.cast("double")),
            "statement": F.when(timed, (F.col(N) - rank).cast("int")),
            "cumcount": F.when(timed, F.col(RN) - F.col("__tie_start")),
        }
    ).drop("__tie_start", "__ties", "__untimed")


def longest_history(df: DataFrame, spec: PanelSpec) -> int:
    """Rows of the longest entity."""
    return df.groupBy(spec.entity).count().agg(F.max("count")).first()[0] or 0


def pivot_positions(
    df: DataFrame, spec: PanelSpec, columns: list[str], positions: int | None = None
) -> DataFrame:
    """One row per entity, one column ``{c}__TE{j}`` per column and reverse position j.

    Every position of the longest history gets a column, unless ``positions``
    fixes their number. Where that is too wide for a table, ``with_time_ranks``
    has the same values by row: ``statement`` is the position.
    """
    positions = longest_history(df, spec) if positions is None else positions
    if positions * len(columns) > MAX_COLUMNS:
        raise ValueError(f"the pivot would have more than {MAX_COLUMNS} columns; use with_time_ranks, which has them by row")
    ranked = with_time_ranks(df, spec)
    pivoted = position_columns(columns, positions)
    return ranked.groupBy(spec.entity).agg(*[F.expr(f"{e} AS {name(n)}") for n, e in pivoted.items()])


def position_columns(columns: list[str], positions: int) -> dict[str, str]:
    """Aggregates for a pivot by reverse position; the later row wins a shared position."""
    return {
        f"{c}__TE{j}": f"max_by({name(c)}, CASE WHEN statement = {j} THEN {RN} END)"
        for c in columns
        for j in range(positions)
    }
