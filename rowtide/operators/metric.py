"""Weighted ranking metric: normalised gini and capture at the top 4 % of weight.

Negatives weigh 20, positives 1. Rows are ordered by score descending (a missing
score, NULL or NaN, is last), then by key ascending. Rows without a label take no
part. Running weights are integers, so the cut-off is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.functions.numeric import clean, ratio
from rowtide.operators.ordered import OrderedGroups

# Fixed values of the metric.
NEGATIVE_WEIGHT = 20
TOP_SHARE = 0.04


def class_weight(target: Column) -> Column:
    return F.when(target == 0, NEGATIVE_WEIGHT).otherwise(1).cast("long")


def running_weights(
    df: DataFrame, target: str, score: str, key: str, by: Sequence[str] = (), derived: bool = False
) -> DataFrame:
    """Rows with weight, running weight, running positives and group totals.

    ``derived``: ``df`` is expensive (freshly scored rows, say); see ``OrderedGroups``.
    """
    t = F.col(target).cast("long")
    labelled = df.filter(F.col(target).isNotNull())
    shown = clean(F.col(score).cast("double")).alias(score)
    rows = labelled.select(*by, key, shown, t.alias(target), class_weight(t).alias("weight"))
    positives = F.col(target) * F.col("weight")
    unscored = F.col(score).isNull().cast("int")
    groups = OrderedGroups(rows, by, [unscored, -F.col(score), F.col(key)], derived=derived)
    return groups.scan(
        running={"cum_weight": F.col("weight"), "cum_pos": positives},
        sums={
            "total_weight": F.col("weight"),
            "n_pos": positives,
            "n_neg": (F.col(target) == 0).cast("long"),
        },
    )


def _in_top() -> Column:
    return F.col("cum_weight") <= F.floor(F.lit(TOP_SHARE) * F.col("total_weight"))


def top_share(df: DataFrame, target: str, score: str, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows that fit into the top 4 % of the total weight."""
    ranked = running_weights(df, target, score, key, by)
    return ranked.filter(_in_top()).select(*by, key, score, target, "weight", "cum_weight")


def perfect_gini(n_pos: Column, n_neg: Column) -> Column:
    """Gini of the perfect order, in closed form."""
    p, n = n_pos.cast("double"), n_neg.cast("double")
    return ratio(10 * n * (p + 20 * n - 19), p + 20 * n)


def metric_components(
    df: DataFrame, target: str, score: str, key: str, by: Sequence[str] = (), derived: bool = False
) -> DataFrame:
    """One row per group: raw, perfect and normalised gini, top capture, and their mean.

    A component is NULL where it is undefined (one class only).
    """
    ranked = running_weights(df, target, score, key, by, derived)
    lorentz = ratio(F.col("cum_pos"), F.col("n_pos"))
    random = ratio(F.col("cum_weight"), F.col("total_weight"))
    captured = F.when(_in_top() & (F.col(target) == 1), 1).otherwise(0)
    sums = ranked.groupBy(*by).agg(
        F.sum((lorentz - random) * F.col("weight")).alias("gini_raw"),
        F.sum(captured).alias("captured"),
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
    )
    best = sums.withColumn("gini_perfect", perfect_gini(F.col("n_pos"), F.col("n_neg")))
    parts = best.withColumns(
        {
            "gini": ratio(F.col("gini_raw"), F.col("gini_perfect")),
            "top_capture": ratio(F.col("captured"), F.col("n_pos")),
        }
    )
    return parts.withColumn("score", 0.5 * (F.col("gini") + F.col("top_capture"))).select(
        *by, "n_pos", "n_neg", "gini_raw", "gini_perfect", "gini", "top_capture", "score"
    )


def mean_score(fold_scores: DataFrame) -> DataFrame:
    return fold_scores.agg(F.avg("score").alias("mean_score"), F.count("score").alias("folds"))


# Fixed values of the losses.
CLIP = 1e-7
FOCAL_ALPHA = 0.8
FOCAL_GAMMA = 2.0
SMOOTH = 1e-6


def losses(df: DataFrame, target: str, probability: str, by: Sequence[str] = ()) -> DataFrame:
    """Binary cross-entropy, focal loss and dice + cross-entropy over scored rows."""
    t = F.col(target).cast("double")
    raw = F.col(probability)
    p = F.least(F.greatest(raw, F.lit(CLIP)), F.lit(1 - CLIP))
    bce = -(t * F.log(p) + (1 - t) * F.log(1 - p))
    focal = FOCAL_ALPHA * F.pow(1 - F.exp(-bce), F.lit(FOCAL_GAMMA)) * bce
    overlap = (2 * F.sum(t * raw) + SMOOTH) / (F.sum(t) + F.sum(raw) + SMOOTH)
    return df.groupBy(*by).agg(
        F.avg(bce).alias("bce"),
        F.avg(focal).alias("focal"),
        (F.avg(bce) + 1 - overlap).alias("dice_bce"),
    )
