"""Column scalers: rank to Gaussian (with inverse) and standard score.

The rank scaler's fitted state is a table of knots (feature, value, s): the
distinct finite values of a column with their scaled rank. Transforming interpolates
between knots; a value that is missing or not finite has no score. Two exact ways
exist:

* few knots (checked): sorted arrays are shipped to the tasks and Arrow batches
  are interpolated there, with no shuffle at all;
* many knots: the cells of all columns go through one ordered scan with the knots,
  which finds both neighbours of every different value, one lookup, and one
  aggregation back to rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.numeric import clean, erf, erf_array, erfinv, erfinv_array, finite, ratio
from rowtide.operators.lookup import by_row, lookup
from rowtide.operators.ordered import OrderedGroups
from rowtide.session import limits, materialise, ship

# Fixed value: distance of the scaled rank from +-1.
EPSILON = 1e-4
BOUND = 1.0 - EPSILON
KNOT_SCHEMA = "feature string, value double, s double"


def _long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(feature number, value) for every finite cell, after the columns ``keep``."""
    cells = F.array(*[finite(F.col(c)) for c in columns])
    return df.select(*keep, F.posexplode(cells).alias("at", "value")).filter("value IS NOT NULL")


def _name(columns: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in columns]), F.col("at"))


def fit_gauss_rank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Knots of every column; a constant column has a knot without a scaled rank."""
    distinct = _long(df, columns).distinct()
    groups = OrderedGroups(distinct, ["at"], ["value"], derived=True)
    # One count per column, so it can travel as literals instead of a second window.
    sizes = {r["at"]: r["count"] for r in groups.df.groupBy("at").count().collect()}
    size = F.get(F.array(*[F.lit(sizes.get(i, 0)).cast("long") for i in range(len(columns))]), F.col("at"))
    ranked = groups.scan(row_number="__r")
    s = ratio(F.col("__r") - 1, (size - 1) / 2.0 * BOUND) - BOUND
    return ranked.select(_name(columns).alias("feature"), "value", _clipped(s).alias("s"))


def gauss_rank(
    df: DataFrame, knots: DataFrame, columns: Sequence[str], row_id: Sequence[str]
) -> DataFrame:
    """Replace ``columns`` by their Gaussian score; ``knots`` should be a stored table."""
    used = _finite_knots(knots.select("feature", F.col("value").alias("x"), F.col("s").alias("y")))
    few = _few_knots(used, columns)
    if few is not None:
        return _interpolate_broadcast(df, few, columns, finish=_scored_array)
    return _interpolate_joined(df, used, columns, row_id, _scored)


def _finite_knots(knots: DataFrame) -> DataFrame:
    return knots.withColumns({c: finite(F.col(c)) for c in ("x", "y")}).filter("x IS NOT NULL AND y IS NOT NULL")


def _clipped(s: Column) -> Column:
    s = clean(s)
    return F.when(s.isNotNull(), F.greatest(F.least(s, F.lit(BOUND)), F.lit(-BOUND)))


def _scored(answers: DataFrame) -> DataFrame:
    return answers.withColumn("y", _clipped(F.col("y"))).withColumn("y", erfinv(F.col("y")))


def gauss_rank_inverse(
    df: DataFrame, knots: DataFrame, columns: Sequence[str], row_id: Sequence[str]
) -> DataFrame:
    """Map Gaussian scores back to the original scale, extrapolating beyond the outer knots."""
    # Clipped knots share a scaled rank; the smallest value stands for them.
    unique = knots.filter("s IS NOT NULL").groupBy("feature", "s").agg(F.min("value").alias("value"))
    used = _finite_knots(unique.select("feature", F.col("s").alias("x"), F.col("value").alias("y")))
    few = _few_knots(used, columns)
    if few is not None:
        return _interpolate_broadcast(df, few, columns, prepare=erf_array)
    shares = df.withColumns({c: erf(F.col(c)) for c in columns})
    return _interpolate_joined(shares, used, columns, row_id, lambda answers: answers)


def _scored_array(s: np.ndarray) -> np.ndarray:
    return erfinv_array(np.clip(s, -BOUND, BOUND))


def _few_knots(knots: DataFrame, columns: Sequence[str]) -> pd.DataFrame | None:
    """The knots themselves if there are few enough to ship to every task."""
    lim = limits(knots.sparkSession)
    used = knots.filter(F.col("feature").isin(list(columns)))
    return used.toPandas() if lim.may_broadcast(used.count(), used.schema) else None


def _interpolate_broadcast(
    df: DataFrame,
    knots: pd.DataFrame,
    columns: Sequence[str],
    prepare: Callable[[np.ndarray], np.ndarray] | None = None,
    finish: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    tables = {
        name: (part["x"].to_numpy(), part["y"].to_numpy())
        for name, part in knots.dropna().sort_values("x").groupby("feature")
    }
    ship(df.sparkSession)
    shipped = df.sparkSession.sparkContext.broadcast(tables)

    def one(values: np.ndarray, table) -> np.ndarray:
        if table is None or len(table[0]) < 2:
            return np.full(len(values), np.nan)
        xs, ys = table
        values = np.where(np.isfinite(values), values, np.nan)  # here and not in the plan, which stays small
        values = prepare(values) if prepare else values
        hi = np.clip(np.searchsorted(xs, values, side="left"), 1, len(xs) - 1)
        slope = (ys[hi] - ys[hi - 1]) / (xs[hi] - xs[hi - 1])
        out = ys[hi - 1] + (values - xs[hi - 1]) * slope
        out = finish(out) if finish else out
        return np.where(np.isfinite(out), out, np.nan)

    kinds = ", ".join(f"`{c}`: double" for c in columns)

    @F.pandas_udf(f"struct<{kinds}>")
    def scaled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({c: one(frame[c].to_numpy(float), shipped.value.get(c)) for c in columns})

    packed = F.struct(*[F.col(c).cast("double").alias(c) for c in columns])
    out = df.withColumn("__scaled", scaled(packed))
    return out.withColumns({c: clean(F.col("__scaled").getField(c)) for c in columns}).drop("__scaled")


def _interpolate_joined(
    df: DataFrame,
    knots: DataFrame,
    columns: Sequence[str],
    row_id: Sequence[str],
    finish: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    cells = materialise(_long(df, columns, row_id), "cells")
    queries = cells.groupBy("at", "value").agg(F.count(F.lit(1)).alias("__uses"))
    place = F.element_at(F.create_map(*[F.lit(v) for i, c in enumerate(columns) for v in (c, i)]), F.col("feature"))
    knot = F.struct("x", "y")
    points = (
        knots.filter(F.col("feature").isin(list(columns)))
        .select(place.alias("at"), F.col("x").alias("value"), knot.alias("knot"), F.lit(None).cast("long").alias("__uses"))
        .unionByName(queries.withColumn("knot", F.lit(None).cast("struct<x:double,y:double>")))
        .groupBy("at", "value")
        .agg(F.max("knot").alias("knot"), F.max("__uses").alias("__uses"))
    )
    # Beyond the outer knots a query needs the two nearest on one side, so each
    # knot also carries its own neighbours.
    own = OrderedGroups(points.filter("knot IS NOT NULL"), ["at"], ["value"], derived=True)
    linked = _link(own)
    merged = points.drop("knot").join(linked, ["at", "value"], "left")
    groups = OrderedGroups(merged, ["at"], ["value"], derived=True)
    near = groups.neighbours(F.col("linked"), "__at", "__up").filter("__uses IS NOT NULL")

    low = F.coalesce(
        F.when(F.col("__up").isNull(), F.col("__at.before")),
        F.col("__up.before"),
        F.col("__up.knot"),
    )
    high = F.coalesce(
        F.when(F.col("__up").isNull(), F.col("__at.knot")),
        F.when(F.col("__up.before").isNull(), F.col("__up.after")),
        F.col("__up.knot"),
    )
    y = low.getField("y") + (F.col("value") - low.getField("x")) * ratio(
        high.getField("y") - low.getField("y"), high.getField("x") - low.getField("x")
    )
    answers = finish(near.select("at", "value", "__uses", y.alias("y")))
    answers = answers.withColumn("y", finite(F.col("y")))
    scored = lookup(cells, answers, ["at", "value"], uses="__uses")
    names = [f"__y_{c}" for c in columns]
    out = by_row(df, scored, row_id, names)
    return out.withColumns({c: F.col(n) for c, n in zip(columns, names, strict=True)}).drop(*names)


def _link(knots: OrderedGroups) -> DataFrame:
    """Each knot with the knot before and after it."""
    ranked = materialise(
        knots.scan(row_number="__r").select("at", "value", "knot", "__r"), "knots"
    )

    def shifted(by: int, name: str) -> DataFrame:
        return ranked.select("at", (F.col("__r") + by).alias("__r"), F.col("knot").alias(name))

    both = ranked.join(shifted(1, "before"), ["at", "__r"], "left").join(
        shifted(-1, "after"), ["at", "__r"], "left"
    )
    return both.select("at", "value", F.struct("knot", "before", "after").alias("linked"))


def fit_standard(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Parameter table (feature, centre, scale), population standard deviation."""
    stats = df.agg(
        *[F.avg(c).alias(f"avg_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"avg_{c}").alias("centre"),
                F.when(F.col(f"std_{c}") == 0, 1.0).otherwise(F.col(f"std_{c}")).alias("scale"),
            )
            for c in columns
        ]
    )
    return stats.select(F.explode(rows).alias("p")).select("p.*")


def standard_scale(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Subtract the centre, divide by the scale (one parameter row per column)."""
    fitted = {r["feature"]: r for r in params.collect()}

    def score(c: str) -> Column:
        return (F.col(c) - F.lit(fitted[c]["centre"])) / F.lit(fitted[c]["scale"])

    return df.withColumns({c: score(c) for c in columns})
