"""Running sums, row numbers and group totals that never sort a big group in one task.

A window over ``partitionBy(keys)`` puts a whole group into one task. That is
the best plan while every group is small. When some group is larger than a
chunk, its order range is cut into chunks of similar size:

1. a hash sample of the order keys, about ``_OVERSAMPLE`` rows per chunk, shows
   which groups are big and where to cut them (one scan, a tiny shuffle);
2. each row finds its chunk by binary search over its group's boundaries;
3. windows run per (group, chunk); per-chunk totals, combined before the
   shuffle, are summed up in a small table and added as offsets.

Small groups stay whole (chunk 0), so both kinds share one plan and one shuffle.
The sample only steers the cuts; results are exact whatever it holds. Boundary
and offset tables have at most about ``maxChunks`` rows whatever the input size,
because the chunk length grows with the total row count; that bound is what
allows them to be broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.session import limits, materialise

CHUNK = "__chunk"
SPLIT = "__split"
_OVERSAMPLE = 32


def left_join_small(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Broadcast left join on ``keys`` (NULL equals NULL); the caller has bounded ``small``."""
    renamed = small.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return df.join(F.broadcast(renamed), on, "left").drop(*[f"__r_{k}" for k in keys])


def _with_chunk(df: DataFrame, order: Sequence[Column], longest: int) -> DataFrame:
    """Number of boundaries <= the row's key, by binary search over at most ``longest`` of them.

    One projection per halving keeps the search in generated code. Rows without
    boundaries get chunk 0.
    """
    df = df.withColumns({"__key": F.struct(*order), CHUNK: F.lit(0)})
    for i in reversed(range(longest.bit_length())):
        ahead = F.col(CHUNK) + 2**i
        reached = F.get("__bounds", ahead - 1) <= F.col("__key")
        df = df.withColumn(CHUNK, F.when(reached, ahead).otherwise(F.col(CHUNK)))
    return df.withColumn(SPLIT, F.col("__bounds").isNotNull()).drop("__bounds", "__key")


class OrderedGroups:
    """Rows of ``df`` grouped by ``keys`` and totally ordered by ``order`` within a group.

    ``keys`` may be empty (one global group). ``order`` holds ascending
    expressions and must be unique within a group. ``derived`` says that ``df``
    is more than a scan, so it is written once before the passes over it.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str | Column],
        *,
        derived: bool = False,
    ) -> None:
        self.keys = list(keys)
        self.order = [F.col(o) if isinstance(o, str) else o for o in order]
        self.df = materialise(df, "ordered-input") if derived else df
        self.is_split = False
        self._cut()

    @property
    def part(self) -> list[str]:
        """Columns whose windows are safe to run in one task."""
        return [*self.keys, CHUNK] if self.is_split else self.keys

    def _cut(self) -> None:
        lim = limits(self.df.sparkSession)
        chunk_rows = min(lim.rows_per_chunk, max(1, lim.cells_per_chunk // len(self.df.columns)))
        rows = self.df.count()
        if rows <= chunk_rows:
            return
        bounds = self._bounds(max(chunk_rows, math.ceil(rows / lim.max_chunks)))
        longest = bounds.agg(F.max(F.size("__bounds"))).first()[0]
        if not longest:
            return
        if self.keys:
            df = left_join_small(self.df, bounds, self.keys)
        else:
            df = self.df.withColumn("__bounds", bounds.select("__bounds").scalar())
        self.df = _with_chunk(df, self.order, longest)
        self.is_split = True

    def _bounds(self, chunk_rows: int) -> DataFrame:
        """Sorted inner boundaries of every group that needs more than one chunk."""
        keyed = self.df.select(*self.keys, F.struct(*self.order).alias("__key"))
        over = min(_OVERSAMPLE, chunk_rows)  # chunks of a few rows are cut on all rows
        picked = F.pmod(F.xxhash64("__key"), F.lit(chunk_rows)) < over
        sampled = keyed.filter(picked).groupBy(*self.keys).agg(
            F.array_sort(F.collect_list("__key")).alias("__sample")
        )
        chunks = F.ceil(F.size("__sample") / F.lit(over)).cast("int")
        cuts = F.transform(
            F.sequence(F.lit(1), chunks - 1),
            lambda i: F.get("__sample", (i * F.size("__sample") / chunks).cast("int")),
        )
        return materialise(
            sampled.filter(chunks > 1).select(*self.keys, F.array_distinct(cuts).alias("__bounds")),
            "bounds",
        )

    def scan(
        self,
        running: Mapping[str, Column] | None = None,
        sums: Mapping[str, Column] | None = None,
        totals: Mapping[str, Column] | None = None,
        row_number: str | None = None,
    ) -> DataFrame:
        """Rows plus inclusive running sums, group sums and aggregates, and a 1-based position.

        ``running`` and ``sums`` map names to expressions that are summed;
        ``totals`` maps names to any aggregate over the whole group, which costs
        split groups one more pass, so sums belong into ``sums``.
        """
        running, sums, totals = dict(running or {}), dict(sums or {}), dict(totals or {})
        ordered = Window.partitionBy(*self.part).orderBy(*self.order)
        so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(*self.part)
        cols = {name: F.sum(e).over(so_far) for name, e in running.items()}
        if row_number:
            cols[row_number] = F.row_number().over(ordered).cast("long")
            running[row_number] = F.lit(1).cast("long")
        if not self.is_split:
            cols |= {name: F.sum(e).over(whole) for name, e in sums.items()}
            return self.df.withColumns(cols | {name: agg.over(whole) for name, agg in totals.items()})

        if self.keys:  # groups that were not cut; without keys there is only the one that was
            cols |= {name: F.sum(e).over(whole) for name, e in sums.items()}
            cols |= {name: agg.over(whole) for name, agg in totals.items()}
        out = self.df.withColumns(cols)
        hot = self.df.filter(SPLIT)
        if running or sums:
            out = self._with_chunk_sums(out, hot, running, sums)
        if totals:
            table = hot.groupBy(*self.keys).agg(*[a.alias(f"__tot_{n}") for n, a in totals.items()])
            table = materialise(table, "totals")
            if self.keys:
                out = left_join_small(out, table, self.keys)
            else:
                out = out.withColumns({c: table.select(c).scalar() for c in table.columns})
            out = self._settled(out, totals)
        return tidy(out)

    def _with_chunk_sums(
        self,
        out: DataFrame,
        hot: DataFrame,
        running: Mapping[str, Column],
        sums: Mapping[str, Column],
    ) -> DataFrame:
        """Add what earlier chunks hold to running sums, and replace group sums of cut groups."""
        per_chunk = hot.groupBy(*self.keys, CHUNK).agg(
            *[F.sum(e).alias(f"__off_{n}") for n, e in running.items()],
            *[F.sum(e).alias(f"__tot_{n}") for n, e in sums.items()],
        )
        group = Window.partitionBy(*self.keys)
        before = group.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        table = per_chunk.withColumns(
            {f"__off_{n}": F.sum(f"__off_{n}").over(before) for n in running}
            | {f"__tot_{n}": F.sum(f"__tot_{n}").over(group) for n in sums}
        )
        out = left_join_small(out, materialise(table, "offsets"), [*self.keys, CHUNK])
        carried = {
            n: F.when(F.col(f"__off_{n}").isNull(), F.col(n)).otherwise(
                F.coalesce(F.col(n), F.lit(0)) + F.col(f"__off_{n}")
            )
            for n in running
        }
        out = out.withColumns(carried) if carried else out
        return self._settled(out.drop(*[f"__off_{n}" for n in running]), sums)

    def _settled(self, out: DataFrame, names: Mapping[str, Column]) -> DataFrame:
        """Group values of cut groups come from their table, the others from the window."""
        if not names:
            return out
        if self.keys:
            chosen = {n: F.when(F.col(SPLIT), F.col(f"__tot_{n}")).otherwise(F.col(n)) for n in names}
        else:
            chosen = {n: F.col(f"__tot_{n}") for n in names}
        return out.withColumns(chosen).drop(*[f"__tot_{n}" for n in names])

    def neighbours(self, value: Column, previous: str, following: str) -> DataFrame:
        """Nearest non-NULL ``value`` at or before, and at or after, each row."""
        # Looking ahead is looking back in descending order; a frame that runs to
        # the end of the partition would be evaluated anew for every row.
        until = Window.unboundedPreceding, Window.currentRow
        back = Window.partitionBy(*self.part).orderBy(*self.order).rowsBetween(*until)
        reverse = [o.desc_nulls_last() for o in self.order]
        ahead = Window.partitionBy(*self.part).orderBy(*reverse).rowsBetween(*until)
        out = self.df.withColumns(
            {
                previous: F.last(value, ignorenulls=True).over(back),
                following: F.last(value, ignorenulls=True).over(ahead),
            }
        )
        if not self.is_split:
            return out
        key = F.when(value.isNotNull(), F.struct(*self.order))
        ends = (
            self.df.filter(SPLIT)
            .groupBy(*self.keys, CHUNK)
            .agg(F.max_by(value, key).alias("__last"), F.min_by(value, key).alias("__first"))
        )
        before = Window.unboundedPreceding, -1
        up = Window.partitionBy(*self.keys).orderBy(CHUNK).rowsBetween(*before)
        down = Window.partitionBy(*self.keys).orderBy(F.desc(CHUNK)).rowsBetween(*before)
        carried = ends.select(
            *self.keys,
            CHUNK,
            F.last("__last", ignorenulls=True).over(up).alias("__before"),
            F.last("__first", ignorenulls=True).over(down).alias("__after"),
        )
        out = left_join_small(out, materialise(carried, "carried"), [*self.keys, CHUNK])
        return out.withColumns(
            {
                previous: F.coalesce(F.col(previous), F.col("__before")),
                following: F.coalesce(F.col(following), F.col("__after")),
            }
        ).drop("__before", "__after", CHUNK, SPLIT)


def tidy(df: DataFrame) -> DataFrame:
    """Drop the helper columns that splitting adds."""
    return df.drop(CHUNK, SPLIT)
