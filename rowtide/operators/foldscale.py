"""The rank scaler of ``scale`` for all folds at once: fold f's scaler is fitted on the rows of the other folds.

The fitted state is one table (at, value, folds, uses): the distinct finite values of each column, at being the
column's place, with the folds that hold them as bits. A value is a knot of fold f if another fold holds it, so
one ordered scan gives every value its rank among the knots of each fold, and the knots beside it. Cells are shuffled once to
their scores and once back to rows, whatever the number of folds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.functions.numeric import erfinv, finite, ratio
from rowtide.operators.lookup import lookup
from rowtide.operators.ordered import CHUNK, SPLIT, OrderedGroups, left_join_small
from rowtide.operators.scale import BOUND, _clipped, _long
from rowtide.session import materialise

MAX_FOLDS = 63


def fit_gauss_rank_folds(df: DataFrame, columns: Sequence[str], fold: str = "fold") -> DataFrame:
    """at, value, folds, uses; ``fold`` counts from 0."""
    seen = F.expr(f"shiftleft(1L, CAST(`{fold}` AS INT))")
    cells = _long(df, columns, [F.when(F.col(fold).between(0, MAX_FOLDS - 1), seen).alias("__bit")])
    held = F.coalesce(F.bit_or("__bit"), F.lit(0).cast("long"))
    return cells.groupBy("at", "value").agg(held.alias("folds"), F.count(F.lit(1)).alias("uses"))


def gauss_rank_folds(
    df: DataFrame,
    fitted: DataFrame,
    columns: Sequence[str],
    row_id: Sequence[str],
    folds: Sequence[int],
    keep: Sequence[str] = (),
    own: str | None = None,
    fitted_on_these: bool = False,
) -> DataFrame:
    """``row_id``, ``keep`` and the scores as arrays in the order of ``columns``; what has no score is 0.

    One array ``x{f}`` for each of ``folds``, or, with ``own``, one array ``x`` by the scaler of the fold in that
    column. ``fitted`` is a stored table; ``fitted_on_these`` says that it was fitted on the rows of ``df``.
    """
    carried = [*row_id, *([own] if own and own not in row_id else [])]
    cells = materialise(_long(df, columns, carried), "cells")
    if fitted_on_these:
        points = fitted
    else:
        queries = cells.groupBy("at", "value").agg(F.count(F.lit(1)).alias("uses"))
        both = fitted.select("at", "value", "folds", F.lit(None).cast("long").alias("uses")).unionByName(
            queries.withColumn("folds", F.lit(0).cast("long"))
        )
        points = both.groupBy("at", "value").agg(F.max("folds").alias("folds"), F.max("uses").alias("uses"))
    scores = _scores(points, _outer(fitted, folds), folds, stored=fitted_on_these)
    scored = lookup(cells, scores, ["at", "value"], uses="uses")
    if own:
        mine = F.coalesce(*[F.when(F.col(own) == f, F.col(f"y{f}")) for f in folds])
        answers = {"x": mine}
    else:
        answers = {f"x{f}": F.col(f"y{f}") for f in folds}
    scored = scored.select(*row_id, "at", *[a.alias(x) for x, a in answers.items()])
    return _beside_rows(df, scored, row_id, keep, list(answers), len(columns))


def _knot(f: int) -> Column:
    return F.expr(f"(folds & {~(1 << f)}L) <> 0")


def _outer(fitted: DataFrame, folds: Sequence[int]) -> DataFrame:
    """For each column and fold the number of knots and the two knots at each end: one row a column."""
    knots = {f: F.when(_knot(f), F.col("value")) for f in folds}
    first = [a for f in folds for a in (F.count(knots[f]).alias(f"n{f}"), F.min(knots[f]).alias(f"low{f}"), F.max(knots[f]).alias(f"high{f}"))]
    ends = materialise(fitted.groupBy("at").agg(*first), "knot-ends")
    inner = left_join_small(fitted, ends, ["at"]).groupBy("at").agg(
        *[F.min(F.when(knots[f] > F.col(f"low{f}"), F.col("value"))).alias(f"low{f}_2") for f in folds],
        *[F.max(F.when(knots[f] < F.col(f"high{f}"), F.col("value"))).alias(f"high{f}_2") for f in folds],
    )
    return materialise(left_join_small(inner, ends, ["at"]), "knot-ends")


def _scores(points: DataFrame, outer: DataFrame, folds: Sequence[int], stored: bool) -> DataFrame:
    """at, value, uses and the score ``y{f}`` of every value that is used."""
    groups = OrderedGroups(points, ["at"], ["value"], derived=not stored)
    placed = _placed(groups, folds).filter("uses IS NOT NULL")
    placed = left_join_small(placed, outer, ["at"])
    scaled = {f"y{f}": _clipped(finite(_interpolated(f))) for f in folds}
    ranks = placed.select("at", "value", "uses", *[s.alias(y) for y, s in scaled.items()])
    return ranks.withColumns({y: finite(erfinv(F.col(y))) for y in scaled})


def _placed(groups: OrderedGroups, folds: Sequence[int]) -> DataFrame:
    """Points with, for each fold, the knots up to here (``r``), and the nearest knot at or before and at or after."""
    until = Window.unboundedPreceding, Window.currentRow
    up = Window.partitionBy(*groups.part).orderBy("value").rowsBetween(*until)
    down = Window.partitionBy(*groups.part).orderBy(F.desc("value")).rowsBetween(*until)
    knots = {f: F.when(_knot(f), F.col("value")) for f in folds}

    names = [f"{c}{f}" for f in folds for c in ("r", "before", "after")]
    made = [m for f in folds for m in ((F.count(knots[f]), up), (F.max(knots[f]), up), (F.min(knots[f]), down))]
    out = groups.df.withColumns({n: e.over(w) for n, (e, w) in zip(names, made, strict=True)})
    if not groups.is_split:
        return out
    chunks = groups.df.filter(SPLIT).groupBy("at", CHUNK).agg(*[e.alias(n) for n, (e, _) in zip(names, made, strict=True)])
    earlier = Window.partitionBy("at").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("at").orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    beyond = {"r": lambda n: F.sum(n).over(earlier), "b": lambda n: F.max(n).over(earlier), "a": lambda n: F.min(n).over(later)}
    table = chunks.select("at", CHUNK, *[beyond[n[0]](n).alias(f"__{n}") for n in names])
    out = left_join_small(out, materialise(table, "knot-chunks"), ["at", CHUNK])
    whole = {
        n: F.col(n) + F.coalesce(F.col(f"__{n}"), F.lit(0)) if n[0] == "r" else F.coalesce(F.col(n), F.col(f"__{n}"))
        for n in names
    }
    return out.withColumns(whole).drop(*[f"__{n}" for n in names])


def _interpolated(f: int) -> Column:
    """Scaled rank of a value: its own as a knot, else on the line through the knots beside it or the outer two."""
    value, n, r = F.col("value"), F.col(f"n{f}"), F.col(f"r{f}")
    before, after = F.col(f"before{f}"), F.col(f"after{f}")

    def scaled(rank: Column) -> Column:
        return _clipped(ratio(rank - 1, (n - 1) / 2.0 * BOUND) - BOUND)

    def pick(below: Column, above: Column, inside: Column) -> Column:
        return F.when(before.isNull(), below).when(after.isNull(), above).otherwise(inside)

    at = pick(F.lit(1).cast("long"), n - 1, r)
    low = pick(F.col(f"low{f}"), F.col(f"high{f}_2"), before)
    high = pick(F.col(f"low{f}_2"), F.col(f"high{f}"), after)
    line = scaled(at) + (value - low) * ratio(scaled(at + 1) - scaled(at), high - low)
    return F.when(_knot(f), scaled(r)).otherwise(line)


def _beside_rows(df: DataFrame, scored: DataFrame, row_id: Sequence[str], keep: Sequence[str], names: Sequence[str], n: int) -> DataFrame:
    """``row_id`` and ``keep`` of ``df`` with the arrays ``names``; ``row_id`` is unique in ``df``."""
    gathered = scored.repartition(*row_id).groupBy(*row_id).agg(F.array_sort(F.collect_list(F.struct("at", *names))).alias("__cells"))

    def laid(c: str) -> str:
        whole = f"transform(__cells, c -> coalesce(c.{c}, 0D))"
        gaps = f"transform(sequence(0, {n - 1}), i -> coalesce(get(filter(__cells, c -> c.at = i), 0).{c}, 0D))"
        return f"CASE WHEN size(__cells) = {n} THEN {whole} ELSE {gaps} END AS {c}"

    wide = gathered.selectExpr(*[f"`{k}` AS `__r_{k}`" for k in row_id], *[laid(c) for c in names])
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in row_id]
    others = [c for c in keep if c not in row_id]
    joined = df.select(*row_id, *others).join(wide, on, "left").drop(*[f"__r_{k}" for k in row_id])
    return joined.withColumns({c: F.coalesce(F.col(c), F.array_repeat(F.lit(0.0), n)) for c in names})
