"""Scores after every boosting round, and stopping on the metric.

Trainers stop on their own loss. Here the stored trees tell what each round adds to each unseen
row: running sums of that are the row's margin after every round, the ranking metric of every
(fold, round) comes from one ordered scan of those margins, and a fold's model is cut after the round
that training would have kept with the given patience.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.operators.metric import metric_components
from rowtide.plans.models import node_table, tree_parts
from rowtide.plans.training import TrainSpec, fit_fold
from rowtide.session import materialise
from rowtide.sources.cache import cached_table

DIGITS = 9  # of margins and scores, so that ties do not hang on the order of additions
_BLOCK = 64  # running sums are made block by block: appending to one long array would copy it each time


def _running(parts: str) -> str:
    """The running sums of an array, as an array."""
    blocks = f"transform(sequence(0, (size({parts}) - 1) div {_BLOCK}), b -> slice({parts}, b * {_BLOCK} + 1, {_BLOCK}))"
    total = "aggregate(b, 0D, (s, p) -> s + p)"
    starts = f"aggregate({blocks}, array(0D), (a, b) -> concat(a, array(element_at(a, -1) + {total})))"
    grown = "concat(o, array(element_at(o, -1) + p))"
    inner = f"slice(aggregate(b, array(get(t.starts, i)), (o, p) -> {grown}), 2, {_BLOCK})"
    held = f"array(named_struct('starts', {starts}, 'blocks', {blocks}))"  # named, so that it is made once
    return f"transform({held}, t -> flatten(transform(t.blocks, (b, i) -> {inner})))[0]"


def staged_margins(train: DataFrame, spec: TrainSpec, nodes: DataFrame | None = None, every: int = 1) -> DataFrame:
    """key, target, fold, iteration (from 1), margin of unseen rows after every round, or every ``every``-th and the last."""
    spark = train.sparkSession
    rows = train.withColumn("target", F.col(spec.target))
    keep = [spec.key, "target", "fold"]
    parts = tree_parts(rows, nodes if nodes is not None else node_table(spark, spec), spec, keep)
    rounds = parts.select(*keep, F.posexplode(F.expr(_running("parts"))).alias("at", "margin"), F.size("parts").alias("of"))
    iteration = F.col("at") + 1
    return rounds.filter((iteration % every == 0) | (iteration == F.col("of"))).select(
        *keep, iteration.alias("iteration"), F.round("margin", DIGITS).alias("margin")
    )


def curve(margins: DataFrame, key: str) -> DataFrame:
    """fold, iteration and the metric of the rows' order by margin, for each of them."""
    scores = metric_components(margins, "target", "margin", key, by=["fold", "iteration"], derived=True)
    # Rounded, so that rounds that only differ by rounding are equal.
    return scores.select("fold", "iteration", *[F.round(c, DIGITS).alias(c) for c in ("gini", "top_capture", "score")])


def stopping(scores: DataFrame, patience: int, by: str = "fold", step: str = "iteration", highest: bool = True) -> DataFrame:
    """``scores`` with ``waited``, ``stopped`` and ``best``: where training stops, and what it keeps.

    ``waited`` counts steps since the best score so far (the first of equal ones). Training stops at the first
    step that has waited ``patience``, or at the last one; it keeps the best step until then. A missing
    score is never the best, unless there is no other.
    """
    worst = float("-inf") if highest else float("inf")
    shown = F.coalesce(F.col("score"), F.lit(worst))
    order = Window.partitionBy(by).orderBy(step)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    before = (F.max if highest else F.min)(shown).over(earlier)
    is_new = before.isNull() | ((shown > before) if highest else (shown < before))
    df = scores.withColumn("__new", F.when(is_new, F.col(step)))
    df = df.withColumn("__at", F.max("__new").over(so_far)).withColumn("waited", F.col(step) - F.col("__at"))
    whole = Window.partitionBy(by)
    end = F.coalesce(F.min(F.when(F.col("waited") >= patience, F.col(step))).over(whole), F.max(step).over(whole))
    df = df.withColumn("__end", end)
    kept = F.max(F.when(F.col(step) <= F.col("__end"), F.col("__at"))).over(whole)
    return df.withColumns({"stopped": F.col(step) == F.col("__end"), "best": F.col(step) == kept}).drop("__new", "__at", "__end")


def cut(nodes: DataFrame, stops: DataFrame) -> DataFrame:
    """The trees up to each fold's best round."""
    best = stops.filter("best").select("fold", F.col("iteration").alias("__keep"))
    return nodes.join(F.broadcast(best), "fold").filter(F.col("tree") < F.col("__keep")).drop("__keep")


def fit_stopped(train: DataFrame, spec: TrainSpec, patience: int = 600, every: int = 1) -> tuple[DataFrame, DataFrame]:
    """(learning curve with stopping flags, nodes of the kept trees), both stored in the run's folder.

    ``train`` is a stored table with ``fold``. Models that are stored already are not trained again.
    """
    if spec.stop != "metric":
        raise ValueError('pass a TrainSpec with stop="metric": the trainer would stop by itself')
    spark = train.sparkSession
    for fold in range(spec.folds):
        fit_fold(train, spec, fold)
    mark = f"{spec.fingerprint}:{patience}:{every}"
    stops = cached_table(
        spark,
        f"{spec.folder}/curve",
        lambda: stopping(materialise(curve(staged_margins(train, spec, every=every), spec.key), "curve"), patience),
        mark,
    )
    kept = cached_table(spark, f"{spec.folder}/kept_nodes", lambda: cut(node_table(spark, spec), stops), mark)
    return stops, kept
