"""Early stopping of the network: training in segments from carried weights.

The trainer runs a fixed number of steps. A segment runs a few of them from the weights that the
segment before it left, and is judged by the log-loss of the held-out fold. Each segment leaves one
row (segment, weights, loss) in the run's folder, so a run that was stopped goes on after its last segment, and
a run that has ended trains nothing. Training ends when ``patience`` segments have not lowered the loss, or
after ``most`` segments; the best segment's model is stored as the fold's model, from where it
is loaded, exported and scored like any other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.operators.metric import losses
from rowtide.plans.models import network_scores, weights_of
from rowtide.plans.staged import DIGITS, stopping
from rowtide.plans.training import TrainSpec, estimator, network_rows, scaled_train
from rowtide.sources.cache import finished, require_same


@dataclass(frozen=True)
class Segments:
    """Steps of a segment, segments without a lower loss before training ends, and segments at most."""

    steps: int = 10
    patience: int = 12
    most: int = 40


_STATE = "segment int, loss double, weights array<double>"


def _path(spec: TrainSpec, fold: int, segment: int) -> str:
    return f"{spec.folder}/segments_{fold}/segment_{segment}"


def _loss(held_out: DataFrame, spec: TrainSpec, weights: list[float]) -> float:
    """Log-loss of the held-out rows, by the same joins that score."""
    spark = held_out.sparkSession
    flat = spark.createDataFrame([(0, weights)], "fold int, flat array<double>")
    table = weights_of(flat, spec.layers, ["fold"])
    scored = network_scores(held_out.withColumn("fold", F.lit(0)), table, len(spec.layers) - 1, ["target"])
    return round(losses(scored, "target", "prediction").first()["bce"], DIGITS)


def fit_network(
    train: DataFrame, spec: TrainSpec, fold: int, segments: Segments = Segments(), scaled_rows: Callable[[], DataFrame] | None = None
) -> DataFrame:
    """Train one fold; the state table (segment, loss, weights) of all its segments.

    ``train`` is a stored table with ``fold``. ``scaled_rows``: what gives its ``scaled_train``, if it serves several folds.
    """
    if spec.model != "network":
        raise ValueError("only networks are trained in segments; see staged.fit_stopped for trees")
    spark = train.sparkSession
    require_same(spark, f"{spec.folder}/segments_{fold}", f"{spec.fingerprint}:{segments}")
    done: list[tuple[float, list[float]]] = []
    inputs = held_out = None
    for i in range(segments.most):
        if _waited([loss for loss, _ in done]) >= segments.patience:
            break
        path = _path(spec, fold, i)
        if not finished(spark, path):
            if inputs is None:
                rows = scaled_rows() if scaled_rows else scaled_train(train, spec)
                label = F.col(spec.target).cast("double").alias("label")
                inputs = network_rows(rows.filter(F.col("fold") != fold), spec, fold).select(label, "inputs")
                held_out = rows.filter(F.col("fold") == fold).select(F.col(spec.target).alias("target"), F.col(f"x{fold}").alias("x"))
            trainer = estimator(spec).setMaxIter(segments.steps).setSeed(spec.seed)
            if done:
                trainer.setInitialWeights(Vectors.dense(done[-1][1]))
            model = trainer.fit(inputs)
            weights = [float(w) for w in model.weights.toArray()]
            loss = _loss(held_out, spec, weights)
            if not done or loss < min(old for old, _ in done):
                model.write().overwrite().save(spec.model_path(fold))
            spark.createDataFrame([(i, loss, weights)], _STATE).coalesce(1).write.mode("overwrite").parquet(path)
        row = spark.read.schema(_STATE).parquet(path).first()
        done.append((row["loss"], list(row["weights"])))
    return _states(train, spec, fold, len(done))


def _waited(losses_: list[float]) -> int:
    """Segments since the lowest loss."""
    return len(losses_) - 1 - losses_.index(min(losses_)) if losses_ else 0


def _states(train: DataFrame, spec: TrainSpec, fold: int, n: int) -> DataFrame:
    read = train.sparkSession.read.schema(_STATE)
    return read.parquet(*[_path(spec, fold, i) for i in range(n)])


def fit_networks(train: DataFrame, spec: TrainSpec, segments: Segments = Segments()) -> DataFrame:
    """All folds: fold, segment, loss, weights of every segment."""
    out = None
    scaled_rows = cache(lambda: scaled_train(train, spec))
    for fold in range(spec.folds):
        part = fit_network(train, spec, fold, segments, scaled_rows).select(F.lit(fold).alias("fold"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def learning_curve(states: DataFrame, patience: int) -> DataFrame:
    """fold, segment, loss with ``waited``, ``stopped`` and ``best``."""
    scores = states.select("fold", "segment", F.col("loss").alias("score"))
    return stopping(scores, patience, step="segment", highest=False).withColumnRenamed("score", "loss")
