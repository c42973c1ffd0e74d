"""Quantile transformer: values to their place among a column's quantiles, or to normal scores.

Fitting takes exact quantiles of many columns in two passes and no sort of the data. A mergeable summary
(``approx_percentile``) gives cut points whose ranks are within ``1 / ACCURACY`` of the rows; one pass
counts the values between neighbouring cuts, exactly, so each wanted rank is known to lie in one
stretch between two cuts. The second pass shuffles the values of those stretches only, each with its number. Cuts
only place the stretches, so what comes out is exact, and a value that fills a column
is one row.

A fitted table has (feature, step, reference, value): ``value`` is the quantile at ``reference``, between
order statistics in proportion. Transforming takes no shuffle: the quantiles, which are as many as asked for whatever
the rows, are sent to the tasks, and Arrow batches are looked up there. A value between two quantiles goes in proportion, one that is
equal to several to the middle of theirs, one beyond them to 0 or 1. Missing values
and values that are not finite take no part and stay missing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.functions.numeric import erfinv_array, finite
from rowtide.functions.text import name
from rowtide.session import limits, materialise, ship

ACCURACY = 10_000
# Fixed value: how near to 0 and 1 a share is taken to be when it becomes a normal score.
NORMAL_BOUND = 1e-7


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(at, value) of every finite cell."""
    cells = F.array(*[finite(F.col(name(c))) for c in columns])
    return df.select(F.posexplode(cells).alias("at", "value")).filter("value IS NOT NULL")


def fit_quantiles(df: DataFrame, columns: Sequence[str], quantiles: int = 1000) -> DataFrame:
    """Table (feature, step, reference, value) of ``quantiles`` exact quantiles a column, from least to greatest."""
    if quantiles < 2:
        raise ValueError("two quantiles at least: the least and the greatest value")
    spark = df.sparkSession
    cells = materialise(_cells(df, columns), "quantile-cells")
    n = cells.count()
    # As many stretches as keep one of them within a chunk.
    stretches = min(ACCURACY // 2, max(2 * quantiles, 8 * n // limits(spark).rows_per_chunk), limits(spark).max_chunks)
    shares = [i / stretches for i in range(1, stretches)]
    summary = cells.groupBy("at").agg(F.array_distinct(F.percentile_approx("value", shares, F.lit(ACCURACY))).alias("cuts"))
    summary = materialise(summary, "quantile-cuts")
    placed = _with_stretch(cells, summary, stretches)
    counts = materialise(placed.groupBy("at", "stretch").agg(F.count("*").alias("n")), "quantile-counts")
    whole = Window.partitionBy("at")
    ahead = whole.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sized = counts.withColumns({"before": F.coalesce(F.sum("n").over(ahead), F.lit(0)), "total": F.sum("n").over(whole)})
    # Ranks (from 0) on both sides of each quantile, and the part of the way between them.
    steps = F.explode(F.sequence(F.lit(0), F.lit(quantiles - 1))).alias("step")
    spot = F.col("step") / (quantiles - 1) * (F.col("total") - 1)
    wanted = sized.select("at", "total").distinct().select("at", "total", steps).withColumn("spot", spot)
    sides = F.array(F.floor("spot"), F.least(F.floor("spot") + 1, F.col("total") - 1))
    wanted = wanted.select("at", "step", F.col("spot") - F.floor("spot"), F.posexplode(sides)).toDF("at", "step", "part", "side", "rank")
    wanted = wanted.withColumn("rank", F.col("rank").cast("long"))
    ranks = wanted.select("at", "rank").distinct()
    # The stretch of a rank is the last one that begins at it or before.
    begins = sized.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("before", "stretch"))).alias("begins"))
    begins = begins.select("at", "begins", F.col("begins.before").alias("befores"))
    spotted = _halving(ranks.join(F.broadcast(begins), "at"), F.col("rank"), "befores", "__k", stretches, strict=False)
    found = materialise(spotted.select("at", "rank", F.inline(F.array(F.get("begins", F.col("__k") - 1)))), "quantile-ranks")
    # The second pass: values of stretches that hold a wanted rank.
    needed = F.broadcast(found.select("at", "stretch", "before").distinct())
    values = placed.join(needed, ["at", "stretch"]).groupBy("at", "stretch", "before", "value").agg(F.count("*").alias("n"))
    up = Window.partitionBy("at", "stretch").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("end", F.col("before") + F.sum("n").over(up))
    exact = values.join(F.broadcast(found.drop("before")), ["at", "stretch"]).filter(
        (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))
    )
    pair = wanted.join(exact.select("at", "rank", "value"), ["at", "rank"]).groupBy("at", "step", "part").agg(
        F.max(F.when(F.col("side") == 0, F.col("value"))).alias("low"), F.max(F.when(F.col("side") == 1, F.col("value"))).alias("high")
    )
    feature = F.get(F.array(*[F.lit(c) for c in columns]), F.col("at")).alias("feature")
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    return pair.select(feature, "step", (F.col("step") / (quantiles - 1)).alias("reference"), value.alias("value"))


def _halving(df: DataFrame, key: Column, array: str, out: str, longest: int, strict: bool) -> DataFrame:
    """Add ``out``: how many entries of a sorted array are below the key, or (not ``strict``) up to it."""
    df = df.withColumn(out, F.lit(0))
    for i in reversed(range(longest.bit_length())):
        ahead = F.col(out) + 2**i
        entry = F.get(array, ahead - 1)
        reached = entry < key if strict else entry <= key
        df = df.withColumn(out, F.when(reached, ahead).otherwise(F.col(out)))
    return df


def _with_stretch(cells: DataFrame, summary: DataFrame, longest: int) -> DataFrame:
    """The number of cuts up to each value; one row of cuts a column, which is broadcast."""
    joined = cells.join(F.broadcast(summary), "at")
    return _halving(joined, F.col("value"), "cuts", "stretch", longest, strict=False).drop("cuts")


def _placed(values: np.ndarray, table: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Shares of values by (quantiles, references)."""
    if table is None:
        return np.full(len(values), np.nan)
    q, r = table
    values = np.where(np.isfinite(values), values, np.nan)
    below, upto = np.searchsorted(q, values, side="left"), np.searchsorted(q, values, side="right")
    low, high = np.clip(upto - 1, 0, len(q) - 1), np.clip(upto, 0, len(q) - 1)
    with np.errstate(invalid="ignore", divide="ignore"):
        between = r[low] + (values - q[low]) * ((r[high] - r[low]) / (q[high] - q[low]))
    equal = (r[np.clip(below, 0, len(q) - 1)] + r[low]) / 2
    out = np.where(below < upto, equal, between)
    # The ends stand for all that is beyond them, also where they are repeated.
    out = np.where(values <= q[0], 0.0, np.where(values >= q[-1], 1.0, out))
    return np.where(np.isnan(values), np.nan, out)


def quantile_transform(df: DataFrame, fitted: DataFrame, columns: Sequence[str], output: str = "uniform") -> DataFrame:
    """Replace ``columns`` by their place in [0, 1], or by its normal score (``output="normal"``)."""
    if output not in ("uniform", "normal"):
        raise ValueError(f"output must be 'uniform' or 'normal', not {output!r}")
    rows = fitted.filter(F.col("feature").isin(list(columns))).orderBy("feature", "step").toPandas()
    tables = {f: (part["value"].to_numpy(float), part["reference"].to_numpy(float)) for f, part in rows.groupby("feature")}
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(tables)
    normal = output == "normal"

    def one(values: np.ndarray, table) -> np.ndarray:
        share = _placed(values, table)
        if not normal:
            return share
        held = np.clip(share, NORMAL_BOUND, 1 - NORMAL_BOUND)
        return erfinv_array(2 * held - 1) * np.sqrt(2.0)

    @F.pandas_udf(", ".join(f"c{i} double" for i in range(len(columns))))
    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({f"c{i}": one(frame[f"c{i}"].to_numpy(float), sent.value.get(c)) for i, c in enumerate(columns)})

    packed = F.struct(*[F.col(name(c)).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    out = df.withColumn("__placed", placed(packed))
    places = {c: f"nanvl(__placed.c{i}, CAST(NULL AS DOUBLE))" for i, c in enumerate(columns)}
    return out.selectExpr(*[f"{places[c]} AS {name(c)}" if c in places else name(c) for c in df.columns])
