"""Permutation importance: how much the metric of unseen rows falls when one feature is shuffled.

A permutation is seeded and needs no sort in one task: within each fold, the row whose key has rank i by one hash
takes the values of the row with rank i by another one. Both ranks come from ordered scans that cut
large folds, and one join brings every row its donor, for all features at once. A row is then scored as often as
there are features: with one feature of the donor and all others of its own, through the node table, by the model that
has not seen it. Features that no tree of any fold asks for are not scored: shuffling them changes nothing, and
their importance is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.text import name, quoted
from rowtide.operators.folds import seeded
from rowtide.operators.metric import metric_components
from rowtide.operators.ordered import OrderedGroups
from rowtide.plans.models import node_table, tree_parts
from rowtide.plans.staged import DIGITS
from rowtide.plans.training import TrainSpec
from rowtide.session import materialise

_TAKES, _GIVES = 1, 2


def donors(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """key, donor: a seeded permutation of the keys within each ``fold``."""
    slim = rows.select(key, "fold")
    takes, gives = (
        OrderedGroups(slim, ["fold"], [seeded(key, seed * 2 + side), F.col(key)], derived=True).scan(row_number="__rank")
        for side in (_TAKES, _GIVES)
    )
    gives = gives.select(F.col(key).alias("donor"), F.col("fold").alias("__fold"), F.col("__rank").alias("__place"))
    same = F.col("fold").eqNullSafe(F.col("__fold")) & (F.col("__rank") == F.col("__place"))
    return takes.join(gives, same).select(key, "donor")


def shuffled_scores(train: DataFrame, spec: TrainSpec, nodes: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """key, target, fold, feature, margin of unseen rows; ``feature`` is the one that is shuffled, null for none."""
    spark = train.sparkSession
    nodes = nodes if nodes is not None else node_table(spark, spec)
    asked = sorted(r[0] for r in nodes.filter("feature IS NOT NULL").select("feature").distinct().collect())
    own = F.struct(*[F.col(name(f)) for f in spec.features]).alias("own")
    rows = train.select(spec.key, F.col(spec.target).alias("target"), "fold", own)
    pairs = materialise(donors(rows, spec.key, seed), "donors")
    given = rows.select(F.col(spec.key).alias("donor"), F.col("own").alias("given"))
    both = materialise(rows.join(pairs, spec.key).join(given, "donor"), "donated")
    features = F.explode(F.array(F.lit(None).cast("string"), *[F.lit(f) for f in asked])).alias("feature")
    laid = both.select(spec.key, "target", "fold", "own", "given", features)
    mixed = [
        f"CASE WHEN feature = {quoted(f)} THEN given.{name(f)} ELSE own.{name(f)} END AS {name(f)}" if f in asked else f"own.{name(f)} AS {name(f)}"
        for f in spec.features
    ]
    keep = [spec.key, "target", "fold", "feature"]
    shown = laid.selectExpr(*[name(c) for c in keep], *mixed)
    parts = tree_parts(shown.withColumnRenamed("feature", "__feature"), nodes, spec, [spec.key, "target", "fold", "__feature"])
    margin = F.round(F.aggregate("parts", F.lit(0.0), lambda a, p: a + p), DIGITS)
    return parts.select(spec.key, "target", "fold", F.col("__feature").alias("feature"), margin.alias("margin"))


def permutation_importance(train: DataFrame, spec: TrainSpec, nodes: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """fold, feature, score (with the feature shuffled), base, importance (base - score), for every feature of the run."""
    spark = train.sparkSession
    margins = shuffled_scores(train, spec, nodes, seed)
    scores = metric_components(margins, "target", "margin", spec.key, by=["fold", "feature"], derived=True)
    scores = materialise(scores.select("fold", "feature", F.round("score", DIGITS).alias("score")), "shuffled-scores")
    base = scores.filter("feature IS NULL").select(F.col("fold").alias("__fold"), F.col("score").alias("base"))
    every = F.explode(F.array(*[F.lit(f) for f in spec.features])).alias("feature")
    listed = base.select(F.col("__fold").alias("fold"), "base", every)
    found = scores.filter("feature IS NOT NULL").select(F.col("fold").alias("__f"), F.col("feature").alias("__feature"), "score")
    same = (F.col("fold") == F.col("__f")) & (F.col("feature") == F.col("__feature"))
    out = listed.join(F.broadcast(found), same, "left").withColumn("score", F.coalesce("score", "base"))
    return out.select("fold", "feature", "score", "base", F.round(F.col("base") - F.col("score"), DIGITS).alias("importance"))


def mean_importance(importance: DataFrame) -> DataFrame:
    """feature and its mean importance over the folds."""
    return importance.groupBy("feature").agg(F.avg("importance").alias("importance"))
