"""Parameter search: candidates are fitted without fold 0 and judged on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.operators.metric import metric_components
from rowtide.plans.training import TrainSpec, _inputs, _probability, estimator
from rowtide.session import ensure_checkpoints


def grid(choices: Mapping[str, Sequence[object]]) -> list[dict[str, object]]:
    return [dict(zip(choices, values, strict=True)) for values in product(*choices.values())]


def search(train: DataFrame, spec: TrainSpec, candidates: Sequence[Mapping[str, object]]) -> DataFrame:
    """One row per candidate with its metric on fold 0, best first."""
    rows = train.withColumns(
        {"held_out": F.col("fold") == 0, "label": F.col(spec.target).cast("double")}
    )
    inputs = _inputs(rows, spec, 0, fit_on=rows.filter("NOT held_out"))
    ensure_checkpoints(train.sparkSession)
    out = None
    for i, candidate in enumerate(candidates):
        trial = replace(spec, params=tuple({**dict(spec.params), **candidate}.items()))
        seen = inputs if spec.model == "trees" else inputs.filter("NOT held_out")
        model = estimator(trial).fit(seen.select("inputs", "label", "held_out"))
        judged = model.transform(inputs.filter("held_out")).select(
            spec.key, F.col(spec.target).alias("target"), _probability().alias("prediction")
        )
        row = metric_components(judged, "target", "prediction", spec.key, derived=True).select(
            F.lit(i).alias("candidate"),
            F.lit(", ".join(f"{k}={v}" for k, v in candidate.items())).alias("params"),
            "gini",
            "top_capture",
            "score",
        )
        out = row if out is None else out.unionByName(row)
    return out.orderBy(F.col("score").desc_nulls_last(), "candidate")
