"""Queries whose predictions DuckDB makes again from the stored models.

A query exports the models that it scores with (nodes of trees, weights of networks) to a folder that its SQL reads,
and returns predictions by the engine's own joins. Tree features are those of the panel SQL, from the
given tables; inputs of a network are exported, as its scaler is tested by queries of its own.
"""

from __future__ import annotations

import re
import tempfile
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.catalog import query
from rowtide.catalog.features import TREES
from rowtide.catalog.fixtures import ORDERS, as_doubles, rounded
from rowtide.catalog.sqlfeatures import feature_sql, filled_sql
from rowtide.catalog.training import FOLDED, TEST, panels
from rowtide.plans.models import node_table, score_blend, score_out_of_fold, weight_table, weights_of
from rowtide.plans.staged import fit_stopped, staged_margins
from rowtide.plans.stopping import Segments, fit_networks, learning_curve
from rowtide.plans.study import Between, Halving, OneOf, sample, study
from rowtide.plans.training import TrainSpec, fit_fold, scaled_by_all, scaled_by_own, store_folds
from rowtide.session import materialise, new_path, work_dir

_LOCAL = f"{tempfile.gettempdir()}/rowtide-export"


def export(df: DataFrame, name: str) -> DataFrame:
    """Store a table where SQL finds it: a fixed folder in local mode, the shared one on a cluster."""
    spark = df.sparkSession
    local = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    path = f"{_LOCAL if local else work_dir(spark) + '/rowtide-export'}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df


def exported(name: str) -> str:
    return f"read_parquet('{_LOCAL}/{name}/*.parquet')"


PATIENCE = 3
_PARAMS = (("maxIter", 8), ("maxDepth", 3), ("stepSize", 0.2))
_runs: dict[tuple, tuple[DataFrame, DataFrame, TrainSpec]] = {}


def tree_run(spark, sf_dir, stop: str) -> tuple[DataFrame, DataFrame, TrainSpec]:
    """(training table, test table, TrainSpec) with trained folds; once for each session and folder.

    Features are rounded, so that both engines compare the same numbers with thresholds.
    """
    at = (spark.sparkContext.applicationId, sf_dir, stop)
    if at not in _runs:
        train, test, spec = panels(spark, sf_dir, "trees")
        shown = as_doubles(train.drop("target", "fold"), "o_custkey")
        folded = train.select("o_custkey", "target", "fold").join(shown, "o_custkey")
        spec = replace(spec, folder=new_path(spark, "models"), params=_PARAMS, stop=stop)
        train = store_folds(folded, new_path(spark, "folded"))
        for fold in range(spec.folds):
            fit_fold(train, spec, fold)
        _runs[at] = train, materialise(as_doubles(test, "o_custkey"), "test"), spec
    return _runs[at]


_FEATURES = filled_sql(feature_sql(ORDERS, TREES), "o_custkey")


def parts_sql(rows: str, nodes: str) -> str:
    """o_custkey, fold, tree, part of ``rows`` (o_custkey, fold), by going down the exported nodes."""
    return (
        f"WITH RECURSIVE nodes AS MATERIALIZED (SELECT * FROM {exported(nodes)}), "
        f"feats AS MATERIALIZED (SELECT * FROM (UNPIVOT ({_FEATURES}) ON COLUMNS(* EXCLUDE (o_custkey)) "
        "INTO NAME feature VALUE x)), walk AS ("
        f"SELECT r.o_custkey, r.fold, n.tree, n.node FROM ({rows}) r JOIN nodes n ON n.fold = r.fold AND n.node = 0 "
        "UNION ALL SELECT w.o_custkey, w.fold, w.tree, CASE WHEN f.x <= n.threshold THEN n.below ELSE n.above END "
        "FROM walk w JOIN nodes n ON n.fold = w.fold AND n.tree = w.tree AND n.node = w.node "
        "JOIN feats f ON f.o_custkey = w.o_custkey AND f.feature = n.feature WHERE n.below >= 0) "
        "SELECT w.o_custkey, w.fold, w.tree, n.weight * n.value AS part FROM walk w "
        "JOIN nodes n ON n.fold = w.fold AND n.tree = w.tree AND n.node = w.node WHERE n.below < 0"
    )


_OOF = f"SELECT o_custkey, fold FROM ({FOLDED})"
_UNSEEN = f"SELECT o_custkey, fold FROM (SELECT DISTINCT o_custkey FROM orders WHERE {TEST}), range(5) t(fold)"


def _scored_sql(rows: str, nodes: str) -> str:
    return f"SELECT o_custkey, fold, 1 / (1 + exp(-2 * sum(part))) AS prediction FROM ({parts_sql(rows, nodes)}) GROUP BY ALL"


@query(
    "oof_predictions",
    f"SELECT o_custkey, f.target, fold, round(p.prediction, 9) AS prediction FROM ({FOLDED}) f "
    f"JOIN ({_scored_sql(_OOF, 'oof_predictions')}) p USING (o_custkey, fold)",
)
def oof_predictions(spark, sf_dir):
    train, _, spec = tree_run(spark, sf_dir, "loss")
    export(node_table(spark, spec), "oof_predictions")
    return rounded(score_out_of_fold(train, spec), 9)


@query(
    "blend_predictions",
    "SELECT o_custkey, round(avg(prediction), 9) AS prediction "
    f"FROM ({_scored_sql(_UNSEEN, 'blend_predictions')}) GROUP BY o_custkey",
)
def blend_predictions(spark, sf_dir):
    _, test, spec = tree_run(spark, sf_dir, "loss")
    export(node_table(spark, spec), "blend_predictions")
    return rounded(score_blend(test, spec), 9)


def _margins_sql(nodes: str) -> str:
    return (
        "SELECT o_custkey, f.target, fold, CAST(tree + 1 AS INT) AS iteration, "
        "round(sum(part) OVER (PARTITION BY o_custkey ORDER BY tree), 9) AS margin "
        f"FROM ({parts_sql(_OOF, nodes)}) JOIN ({FOLDED}) f USING (o_custkey, fold)"
    )


@query("staged_margins", _margins_sql("staged_margins"))
def staged(spark, sf_dir):
    train, _, spec = tree_run(spark, sf_dir, "metric")
    export(node_table(spark, spec), "staged_margins")
    return staged_margins(train, spec)


def _curve_sql(margins: str) -> str:
    by = "PARTITION BY fold, iteration"
    weighed = (
        "SELECT *, sum(weight) OVER o AS cum_weight, sum(target) OVER o AS cum_pos, sum(weight) OVER g AS total, "
        f"sum(target) OVER g AS p, sum(1 - target) OVER g AS n FROM (SELECT *, 20 - 19 * target AS weight FROM ({margins})) "
        f"WINDOW o AS ({by} ORDER BY margin DESC, o_custkey ROWS UNBOUNDED PRECEDING), g AS ({by})"
    )
    return (
        "SELECT fold, iteration, 0.5::DOUBLE * (raw / (10 * n * (p + 20 * n - 19) / (p + 20 * n)) + captured / p) AS score "
        "FROM (SELECT fold, iteration, max(p)::DOUBLE AS p, max(n)::DOUBLE AS n, "
        "sum((cum_pos::DOUBLE / p::DOUBLE - cum_weight::DOUBLE / total::DOUBLE) * weight) AS raw, "
        "count(*) FILTER (WHERE target = 1 AND cum_weight <= floor(0.04::DOUBLE * total::DOUBLE))::DOUBLE AS captured "
        f"FROM ({weighed}) GROUP BY fold, iteration)"
    )


def stopping_sql(scores: str, patience: int, by: str = "fold", step: str = "iteration", best: str = "max", over: str = ">") -> str:
    """The flags of ``staged.stopping`` for a table with ``score``."""
    order = f"PARTITION BY {by} ORDER BY {step}"
    new = (
        f"SELECT *, CASE WHEN row_number() OVER ({order}) = 1 OR score {over} {best}(score) OVER "
        f"({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN {step} END AS is_new FROM ({scores})"
    )
    at = f"SELECT *, max(is_new) OVER ({order}) AS since FROM ({new})"
    ends = f"SELECT {by}, coalesce(min(CASE WHEN {step} - since >= {patience} THEN {step} END), max({step})) AS last FROM ({at}) GROUP BY {by}"
    kept = f"SELECT {by}, last, max(since) AS kept FROM ({at}) JOIN ({ends}) USING ({by}) WHERE {step} <= last GROUP BY ALL"
    return (
        f"SELECT * EXCLUDE (is_new, since, last, kept), {step} - since AS waited, {step} = last AS stopped, {step} = kept AS best "
        f"FROM ({at}) JOIN ({kept}) USING ({by})"
    )


@query(
    "metric_stopping",
    # Scores that are equal but for their last bits are equal, in both engines.
    stopping_sql(f"SELECT fold, iteration, round(score, 9) AS score FROM ({_curve_sql(_margins_sql('metric_stopping'))})", PATIENCE),
)
def metric_stopping(spark, sf_dir):
    """The learning curve of every fold by the metric, and the rounds that are kept."""
    train, _, spec = tree_run(spark, sf_dir, "metric")
    export(node_table(spark, spec), "metric_stopping")
    stops, _ = fit_stopped(train, spec, PATIENCE)
    return stops.select("fold", "iteration", "score", "waited", "stopped", "best")


@query(
    "stopped_predictions",
    f"SELECT o_custkey, f.target, fold, round(p.prediction, 9) AS prediction FROM ({FOLDED}) f "
    f"JOIN ({_scored_sql(_OOF, 'stopped_predictions')}) p USING (o_custkey, fold)",
)
def stopped_predictions(spark, sf_dir):
    """Out-of-fold predictions of the trees that stopping kept."""
    train, _, spec = tree_run(spark, sf_dir, "metric")
    _, kept = fit_stopped(train, spec, PATIENCE)
    export(kept, "stopped_predictions")
    return rounded(score_out_of_fold(train, spec, kept), 9)


SEGMENTS = Segments(steps=4, patience=1, most=4)


def network_run(spark, sf_dir) -> tuple[DataFrame, DataFrame, TrainSpec, DataFrame]:
    """(training table, test table, TrainSpec, states of all segments); once for each session and folder."""
    at = (spark.sparkContext.applicationId, sf_dir, "network")
    if at not in _runs:
        train, test, spec = panels(spark, sf_dir, "network")
        spec = replace(spec, folder=new_path(spark, "models"), params=(("hidden", (6,)),))
        _runs[at] = train, test, spec, materialise(fit_networks(train, spec, SEGMENTS), "states")
    return _runs[at]


def _export_inputs(df: DataFrame, spec: TrainSpec, name: str, folds: int | None = None) -> None:
    """Scaled inputs, long: o_custkey, target (if any), fold, place, x; each row by its own fold's scaler, or by all."""
    keep = [c for c in ("target", "fold") if c in df.columns]
    if folds is None:
        rows = scaled_by_own(df, spec, keep)
    else:
        each = F.explode(F.array(*[F.struct(F.lit(f).alias("fold"), F.col(f"x{f}").alias("x")) for f in range(folds)]))
        rows = scaled_by_all(df, spec, keep).select("o_custkey", *keep, each.alias("each")).select("o_custkey", *keep, "each.*")
        keep = [*keep, "fold"]
    export(rows.select("o_custkey", *keep, F.posexplode("x").alias("place", "x")), name)


def forward_sql(inputs: str, weights: str, keys: str, by: str) -> str:
    """``keys`` and prediction of exported inputs by a network of one inner layer; ``by`` names the network."""
    unit = "sum(CASE WHEN w.input < 0 THEN w.weight ELSE w.weight * {x} END)"
    on = " AND ".join(f"i.{c} = w.{c}" for c in by.split(", ") if c == "fold")
    group = ", ".join(dict.fromkeys([*keys.split(", "), *by.split(", ")]))
    # The bias is an input of its own, always present.
    fed = f"SELECT * FROM {inputs} UNION ALL BY NAME SELECT DISTINCT * EXCLUDE (place, x), -1 AS place, 1.0::DOUBLE AS x FROM {inputs}"
    picked = ", ".join(f"{'w' if c in by.split(', ') else 'i'}.{c}" for c in group.split(", "))
    hidden = (
        f"SELECT {picked}, w.output AS place, 1 / (1 + exp(-{unit.format(x='i.x')})) AS x "
        f"FROM ({fed}) i JOIN {weights} w ON {on} AND w.layer = 0 AND w.input = i.place GROUP BY ALL"
    )
    both = f"SELECT * FROM ({hidden}) UNION ALL BY NAME SELECT DISTINCT * EXCLUDE (place, x), -1 AS place, 1.0::DOUBLE AS x FROM ({hidden})"
    join = " AND ".join(f"h.{c} = w.{c}" for c in by.split(", "))
    last = (
        f"SELECT {', '.join('h.' + c for c in group.split(', '))}, w.output AS place, {unit.format(x='h.x')} AS z "
        f"FROM ({both}) h JOIN {weights} w ON {join} AND w.layer = 1 AND w.input = h.place GROUP BY ALL"
    )
    return (
        f"SELECT {group}, 1 / (1 + exp(max(z) FILTER (WHERE place = 0) - max(z) FILTER (WHERE place = 1))) AS prediction "
        f"FROM ({last}) GROUP BY {group}"
    )


@query(
    "oof_network_predictions",
    "SELECT o_custkey, target, fold, round(prediction, 9) AS prediction FROM ("
    + forward_sql(exported("oof_network_inputs"), exported("oof_network_weights"), "o_custkey, target, fold", "fold")
    + ")",
)
def oof_network_predictions(spark, sf_dir):
    train, _, spec, _ = network_run(spark, sf_dir)
    _export_inputs(train, spec, "oof_network_inputs")
    export(weight_table(spark, spec), "oof_network_weights")
    return rounded(score_out_of_fold(train, spec), 9)


@query(
    "blend_network_predictions",
    "SELECT o_custkey, round(avg(prediction), 9) AS prediction FROM ("
    + forward_sql(exported("blend_network_inputs"), exported("blend_network_weights"), "o_custkey, fold", "fold")
    + ") GROUP BY o_custkey",
)
def blend_network_predictions(spark, sf_dir):
    _, test, spec, _ = network_run(spark, sf_dir)
    _export_inputs(test, spec, "blend_network_inputs", spec.folds)
    export(weight_table(spark, spec), "blend_network_weights")
    return rounded(score_blend(test, spec), 9)


_CURVE_LOSS = (
    "SELECT fold, segment, avg(-(target * ln(p) + (1 - target) * ln(1 - p))) AS score FROM ("
    "SELECT fold, segment, target, least(greatest(prediction, 1e-7), 1 - 1e-7) AS p FROM ("
    + forward_sql(exported("network_curve_inputs"), exported("network_curve_weights"), "o_custkey, target", "fold, segment")
    + ")) GROUP BY fold, segment"
)


@query(
    "network_curve",
    "SELECT fold, segment, round(score, 6) AS loss, waited, stopped, best FROM ("
    + stopping_sql(f"SELECT fold, segment, round(score, 9) AS score FROM ({_CURVE_LOSS})", SEGMENTS.patience, "fold", "segment", "min", "<")
    + ")",
)
def network_curve(spark, sf_dir):
    """Held-out loss after every segment of the network's training, and which segment is kept."""
    train, _, spec, states = network_run(spark, sf_dir)
    _export_inputs(train, spec, "network_curve_inputs")
    flat = states.withColumnRenamed("weights", "flat")
    export(weights_of(flat, spec.layers, ["fold", "segment"]), "network_curve_weights")
    return rounded(learning_curve(states, SEGMENTS.patience), 6)


SPACE = {
    "maxDepth": Between(2, 4, whole=True),
    "stepSize": Between(0.05, 0.4, log=True),
    "subsamplingRate": Between(0.6, 1.0),
    "featureSubsetStrategy": OneOf(("0.3", "0.5", "0.8")),
}
HALVING = Halving(trials=6, rounds=2, factor=3)


def _drawn_sql(name: str) -> str:
    return f"(('0x' || substr(md5('7:' || trial || ':{name}'), 1, 12))::UBIGINT / 281474976710656.0::DOUBLE)"


def _value_sql(name: str, choice: Between | OneOf) -> str:
    u = _drawn_sql(name)
    if isinstance(choice, OneOf):
        listed = ", ".join(f"'{v}'" for v in choice.values)
        return f"([{listed}])[1 + CAST(floor({u} * {len(choice.values)}) AS INT)] AS {name}"
    low, high = f"{choice.low}::DOUBLE", f"{choice.high}::DOUBLE"
    if choice.whole:
        return f"CAST({choice.low} + floor({u} * {choice.high - choice.low + 1}) AS INT) AS {name}"
    shown = f"{low} * pow({high} / {low}, {u})" if choice.log else f"{low} + {u} * ({high} - {low})"
    return f"round({shown}, 9) AS {name}"


def _rungs_sql() -> str:
    """Who is on which rung follows from the scores of the rung before."""
    rungs, out, on = HALVING.rungs(), [], f"SELECT CAST(trial AS INT) AS trial FROM range({HALVING.trials}) t(trial)"
    for i, (_, rounds) in enumerate(rungs):
        keep = rungs[i + 1][0] if i + 1 < len(rungs) else 1
        placed = (
            f"SELECT {i} AS rung, trial, {rounds} AS rounds, s.iteration, s.score, CAST(row_number() OVER "
            f"(ORDER BY s.score DESC NULLS LAST, trial) AS INT) AS place FROM ({on}) "
            f"JOIN (SELECT * FROM {exported('param_study')} WHERE rung = {i}) s USING (trial)"
        )
        out.append(f"SELECT *, place <= {keep} AS survives FROM ({placed})")
        on = f"SELECT trial FROM ({placed}) WHERE place <= {keep}"
    return " UNION ALL ".join(out)


@query(
    "param_study",
    f"SELECT *, {', '.join(_value_sql(n, c) for n, c in SPACE.items())} FROM ({_rungs_sql()})",
)
def param_study(spark, sf_dir):
    """Drawn parameters, rungs, best rounds, scores, places and survivors of a pruned study."""
    train, _, spec = tree_run(spark, sf_dir, "metric")
    found = materialise(study(train, replace(spec, params=()), SPACE, new_path(spark, "study"), HALVING), "study")
    export(found.select("rung", "trial", "iteration", "score"), "param_study")
    kinds = {n: "string" if isinstance(c, OneOf) else "int" if c.whole else "double" for n, c in SPACE.items()}
    rows = [(t, *sample(SPACE, 7, t).values()) for t in range(HALVING.trials)]
    drawn = spark.createDataFrame(rows, ", ".join(["trial int", *[f"{n} {k}" for n, k in kinds.items()]]))
    return rounded(found.join(F.broadcast(drawn), "trial"), 9)
