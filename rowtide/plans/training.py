"""Fold training with out-of-fold predictions, stored models, and blended scoring."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.operators.columns import require_parity
from rowtide.operators.foldscale import fit_gauss_rank_folds, gauss_rank_folds
from rowtide.operators.metric import metric_components
from rowtide.operators.scale import KNOT_SCHEMA, fit_gauss_rank, gauss_rank
from rowtide.session import ensure_checkpoints, materialise
from rowtide.sources.cache import cached_table, finished, require_same

Fit = Callable[[DataFrame], Model]
HIDDEN = (64, 32)  # units of the network's inner layers


@dataclass(frozen=True)
class TrainSpec:
    """Columns and folder of one training run; ``model`` is ``"trees"`` or ``"network"``."""

    key: str
    target: str
    features: tuple[str, ...]
    folder: str
    model: str = "trees"
    folds: int = 5
    seed: int = 42
    params: tuple[tuple[str, object], ...] = ()
    stop: str = "loss"  # trees: "loss" stops on the trainer's own loss, "metric" leaves that to ``staged``

    @property
    def layers(self) -> list[int]:
        """Units of a network, layer by layer."""
        return [len(self.features), *dict(self.params).get("hidden", HIDDEN), 2]

    def model_path(self, fold: int) -> str:
        return f"{self.folder}/{self.model}_{fold}"

    def knots_path(self, fold: int) -> str:
        return f"{self.folder}/scaler_{fold}"

    @property
    def scaler_path(self) -> str:
        """The scalers of all folds, as one table."""
        return f"{self.folder}/scalers"

    @property
    def fingerprint(self) -> str:
        """What a stored model depends on besides the rows."""
        parts = (self.key, self.target, self.features, self.model, self.folds, self.seed, self.params)
        parts += (self.stop,) if self.stop != "loss" else ()
        return hashlib.sha256(repr(parts).encode()).hexdigest()


def estimator(spec: TrainSpec):
    """Trees stop early on the held-out fold; the network takes Gaussian-ranked inputs."""
    params = dict(spec.params)
    if spec.model == "trees":
        # Depth, step size, row and column shares of the boosted model.
        defaults = {
            "maxDepth": 8,
            "stepSize": 0.02,
            "subsamplingRate": 0.88,
            "featureSubsetStrategy": "0.5",
            "minInstancesPerNode": 8,
            "maxIter": 4000,
        }
        made = GBTClassifier(featuresCol="inputs", labelCol="label", seed=spec.seed, checkpointInterval=10)
        if spec.stop == "loss":
            made.setValidationIndicatorCol("held_out")
        return made.setParams(**{**defaults, **params})
    if spec.model == "network":
        params.pop("hidden", None)
        made = MultilayerPerceptronClassifier(featuresCol="inputs", labelCol="label", layers=spec.layers, seed=spec.seed)
        return made.setParams(**{"maxIter": 400, **params})
    raise ValueError(f"model must be 'trees' or 'network', not {spec.model!r}")


def load_model(spec: TrainSpec, fold: int) -> Model:
    kind = GBTClassificationModel if spec.model == "trees" else MultilayerPerceptronClassificationModel
    return kind.load(spec.model_path(fold))


def store_folds(folded: DataFrame, path: str) -> DataFrame:
    """Write the training table laid out by fold, so that a fold's rows are read alone."""
    folded.write.mode("overwrite").partitionBy("fold").parquet(path)
    return folded.sparkSession.read.schema(folded.schema).parquet(path)


def _assembled(df: DataFrame, spec: TrainSpec) -> DataFrame:
    packer = VectorAssembler(inputCols=list(spec.features), outputCol="inputs", handleInvalid="error")
    return packer.transform(df)


def fold_scalers(train: DataFrame, spec: TrainSpec) -> DataFrame:
    """The scalers of all folds, each fitted on the rows of the others; stored once."""
    return cached_table(train.sparkSession, spec.scaler_path, lambda: fit_gauss_rank_folds(train, spec.features))


def scaled_train(train: DataFrame, spec: TrainSpec) -> DataFrame:
    """Stored: key, target, fold and the network's features by every fold's scaler, as arrays ``x0``, ``x1``, .."""
    fresh = not finished(train.sparkSession, spec.scaler_path)
    scalers = fold_scalers(train, spec)
    keep = [spec.target, "fold"]
    rows = gauss_rank_folds(train, scalers, spec.features, [spec.key], range(spec.folds), keep, fitted_on_these=fresh)
    return materialise(rows, "scaled")


def scaled_by_all(df: DataFrame, spec: TrainSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Key, ``keep`` and the features by every stored scaler, as arrays ``x0``, ``x1``, ..; keys are unique."""
    scalers = df.sparkSession.read.parquet(spec.scaler_path)
    return materialise(gauss_rank_folds(df, scalers, spec.features, [spec.key], range(spec.folds), keep), "scaled")


def scaled_by_own(df: DataFrame, spec: TrainSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Key, ``keep`` and the features by the stored scaler of the row's ``fold``, as array ``x``; keys are unique."""
    scalers = df.sparkSession.read.parquet(spec.scaler_path)
    return materialise(gauss_rank_folds(df, scalers, spec.features, [spec.key], range(spec.folds), keep, own="fold"), "scaled")


def scaled(df: DataFrame, spec: TrainSpec, fold: int, fit_on: DataFrame | None = None) -> DataFrame:
    """Features of the network for one fold; its scaler is fitted on ``fit_on`` and stored, or read."""
    spark, path = df.sparkSession, spec.knots_path(fold)
    if fit_on is None and finished(spark, spec.scaler_path):
        others = [c for c in df.columns if c not in spec.features and c != spec.key]
        rows = gauss_rank_folds(df, spark.read.parquet(spec.scaler_path), spec.features, [spec.key], [fold], others)
        places = {c: i for i, c in enumerate(spec.features)}
        return rows.select(*[F.get(f"x{fold}", F.lit(places[c])).alias(c) if c in places else F.col(f"`{c}`") for c in df.columns])
    if fit_on is not None:
        knots = cached_table(spark, path, lambda: fit_gauss_rank(fit_on, spec.features))
    else:
        knots = spark.read.schema(KNOT_SCHEMA).parquet(path)
    # A constant column has no rank; it enters as 0, the centre of the scale.
    return gauss_rank(df, knots, spec.features, [spec.key]).fillna(0.0, subset=list(spec.features))


def network_rows(rows: DataFrame, spec: TrainSpec, fold: int) -> DataFrame:
    """Rows of ``scaled_train`` or ``scaled_by_all`` as the trainer takes them: ``inputs`` by one fold's scaler."""
    return rows.withColumn("inputs", array_to_vector(f"x{fold}")).drop(*[f"x{f}" for f in range(spec.folds)])


def _inputs(df: DataFrame, spec: TrainSpec, fold: int, fit_on: DataFrame | None = None) -> DataFrame:
    """Model inputs for one fold; the network's scaler is fitted on training rows and stored."""
    return _assembled(scaled(df, spec, fold, fit_on) if spec.model == "network" else df, spec)


def _probability(column: str = "probability"):
    return vector_to_array(F.col(column))[1]


def fit_fold(train: DataFrame, spec: TrainSpec, fold: int, scaled_rows: Callable[[], DataFrame] | None = None) -> Model:
    """Fit on the other folds, or load the stored model of this fold.

    ``scaled_rows``: what gives ``scaled_train`` of a network's rows, if it serves several folds.
    """
    spark = train.sparkSession
    require_same(spark, spec.model_path(fold), spec.fingerprint)
    if finished(spark, f"{spec.model_path(fold)}/metadata"):
        if spec.model == "network":
            fold_scalers(train, spec)
        return load_model(spec, fold)
    label = F.col(spec.target).cast("double")
    if spec.model == "network":
        rows = scaled_rows() if scaled_rows else scaled_train(train, spec)
        inputs = network_rows(rows.filter(F.col("fold") != fold), spec, fold).select("inputs", label.alias("label"))
    else:
        rows = train.withColumns({"held_out": F.col("fold") == fold, "label": label})
        seen = rows.filter(~F.col("held_out"))
        inputs = _inputs(rows if spec.stop == "loss" else seen, spec, fold).select("inputs", "label", "held_out")
    ensure_checkpoints(spark)
    model = estimator(spec).fit(inputs)
    model.write().overwrite().save(spec.model_path(fold))
    return model


def out_of_fold(train: DataFrame, spec: TrainSpec) -> DataFrame:
    """Train every fold; each row is scored once, by the model that has not seen it.

    ``train`` holds key, target, features and ``fold``, and is read many times:
    pass a stored table.
    """
    scored = None
    scaled_rows = cache(lambda: scaled_train(train, spec))
    for fold in range(spec.folds):
        model = fit_fold(train, spec, fold, scaled_rows)
        if spec.model == "network":
            unseen = network_rows(scaled_rows().filter(F.col("fold") == fold), spec, fold)
        else:
            unseen = _inputs(train.filter(F.col("fold") == fold), spec, fold)
        part = model.transform(unseen).select(
            spec.key,
            F.col(spec.target).alias("target"),
            "fold",
            _probability().alias("prediction"),
        )
        scored = part if scored is None else scored.unionByName(part)
    return scored


def fold_scores(predictions: DataFrame, key: str) -> DataFrame:
    """Metric per fold; see also ``mean_score``."""
    return metric_components(predictions, "target", "prediction", key, by=["fold"], derived=True)


def score_panel(train: DataFrame, test: DataFrame, spec: TrainSpec, passthrough: Sequence[str] = ()) -> DataFrame:
    """Blended scores of rows that no model has seen, after a check that both tables have the same features."""
    columns = list(spec.features)
    require_parity(train.select(*[f"`{c}`" for c in columns]), test.select(*[f"`{c}`" for c in columns]))
    return blend(test, spec, passthrough)


def blend(test: DataFrame, spec: TrainSpec, passthrough: Sequence[str] = ()) -> DataFrame:
    """Mean of all fold models' probabilities.

    Trees need no shuffle; a network's rows are scaled for all folds in one pass.
    """
    trees = spec.model == "trees"
    rows = _assembled(test, spec) if trees else scaled_by_all(test, spec, passthrough)
    for fold in range(spec.folds):
        model = load_model(spec, fold)
        model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("__prob")
        fed = rows if trees else rows.withColumn("inputs", array_to_vector(f"x{fold}"))
        rows = model.transform(fed).withColumn(f"__p{fold}", _probability("__prob")).drop("__prob")
        rows = rows if trees else rows.drop("inputs")
    total = sum((F.col(f"__p{f}") for f in range(spec.folds)), F.lit(0.0))
    return rows.select(spec.key, *passthrough, (total / spec.folds).alias("prediction"))
