"""Queries that train models on every feature column and score customers that no model has seen.

Scores depend on the trainer and have no SQL. What is determined has: which rows are
scored, their target and fold, class counts and the perfect gini, and that each real
prediction is a probability.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from rowtide.catalog import query
from rowtide.catalog.encoding import erfinv_sql
from rowtide.catalog.features import TREES
from rowtide.catalog.fixtures import ORDERS, labels, orders, rounded
from rowtide.catalog.sqlfeatures import feature_sql
from rowtide.operators.columns import feature_columns
from rowtide.operators.folds import stratified_folds
from rowtide.operators.scale import BOUND, fit_gauss_rank, gauss_rank
from rowtide.plans.feature_row import attach, feature_row
from rowtide.plans.network import network_row
from rowtide.plans.search import grid, search
from rowtide.plans.training import TrainSpec, fold_scores, out_of_fold, score_panel, store_folds
from rowtide.session import materialise, new_path
from rowtide.spec import FeatureOptions

_SMALL_TREES = (("maxIter", 4), ("maxDepth", 3), ("stepSize", 0.2))
_SMALL_NETWORK = (("maxIter", 15), ("hidden", (6,)))
NETWORK = FeatureOptions.for_networks(ORDERS, narrow=False)
TEST = "o_custkey % 5 = 0"  # customers that are scored and never trained on

FOLDED = (
    "SELECT o_custkey, target, CAST((row_number() OVER (PARTITION BY target ORDER BY md5('42:' || o_custkey), "
    "o_custkey) - 1) % 5 AS INT) AS fold FROM (SELECT DISTINCT o_custkey, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END "
    f"AS target FROM orders JOIN customer ON c_custkey = o_custkey WHERE NOT ({TEST}))"
)
_SCORED = f"SELECT DISTINCT o_custkey, TRUE AS in_range FROM orders WHERE {TEST}"
_IN_RANGE = "prediction BETWEEN 0 AND 1 AS in_range"


def panels(spark, sf_dir, model: str):
    """(folded training table, test table, TrainSpec) on all feature columns."""
    rows = orders(spark, sf_dir)
    seen, unseen = rows.filter(f"NOT ({TEST})"), rows.filter(TEST)
    if model == "trees":
        train, test = (feature_row(part, ORDERS, TREES) for part in (seen, unseen))
    else:
        path = new_path(spark, "categories")
        train, test = (network_row(part, ORDERS, NETWORK, path) for part in (seen, unseen))
    labelled = attach(train, labels(spark, sf_dir), "o_custkey")
    features = tuple(feature_columns(labelled, ["o_custkey", "target"]))
    folded = stratified_folds(labelled, "o_custkey", "target", derived=True)
    params = _SMALL_TREES if model == "trees" else _SMALL_NETWORK
    spec = TrainSpec("o_custkey", "target", features, new_path(spark, "models"), model, params=params)
    return store_folds(folded, new_path(spark, "folded")), materialise(test, "test"), spec


def _out_of_fold(spark, sf_dir, model):
    train, _, spec = panels(spark, sf_dir, model)
    return out_of_fold(train, spec).selectExpr("o_custkey", "target", "fold", _IN_RANGE)


@query("oof_train", f"SELECT o_custkey, target, fold, TRUE AS in_range FROM ({FOLDED})")
def oof_train(spark, sf_dir):
    return _out_of_fold(spark, sf_dir, "trees")


@query("oof_train_network", f"SELECT o_custkey, target, fold, TRUE AS in_range FROM ({FOLDED})")
def oof_train_network(spark, sf_dir):
    return _out_of_fold(spark, sf_dir, "network")


@query(
    "oof_scores",
    "SELECT fold, CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg, "
    "round(10 * n::DOUBLE * (p + 20 * n - 19)::DOUBLE / (p + 20 * n)::DOUBLE, 4) AS gini_perfect, TRUE AS judged "
    f"FROM (SELECT fold, sum(target) AS p, sum(1 - target) AS n FROM ({FOLDED}) GROUP BY fold)",
)
def oof_scores(spark, sf_dir):
    train, _, spec = panels(spark, sf_dir, "trees")
    scores = fold_scores(materialise(out_of_fold(train, spec), "oof"), "o_custkey")
    judged = F.col("score").between(-1, 1) & F.col("top_capture").between(0, 1)
    return rounded(scores.select("fold", "n_pos", "n_neg", "gini_perfect", judged.alias("judged")), 4)


def _blend(spark, sf_dir, model):
    train, test, spec = panels(spark, sf_dir, model)
    out_of_fold(train, spec)
    return score_panel(train, test, spec).selectExpr("o_custkey", _IN_RANGE)


@query("blend_predict", _SCORED)
def blend_predict(spark, sf_dir):
    return _blend(spark, sf_dir, "trees")


@query("blend_predict_network", _SCORED)
def blend_predict_network(spark, sf_dir):
    return _blend(spark, sf_dir, "network")


_GRID = {"maxDepth": [2, 3], "stepSize": [0.1, 0.3]}


@query(
    "param_search",
    " UNION ALL ".join(
        f"SELECT {i} AS candidate, '{', '.join(f'{k}={v}' for k, v in c.items())}' AS params, count(*) > 0 AS judged "
        f"FROM ({FOLDED}) WHERE fold = 0"
        for i, c in enumerate(grid(_GRID))
    ),
)
def param_search(spark, sf_dir):
    train, _, spec = panels(spark, sf_dir, "trees")
    found = search(train, replace(spec, params=(("maxIter", 3),)), grid(_GRID))
    return found.select("candidate", "params", F.col("score").between(-1, 1).alias("judged"))


# Only values that both engines have to the last bit, so that ties are the same.
EXACT = FeatureOptions.for_networks(
    ORDERS,
    narrow=False,
    stats=("min", "max"),
    last_lag=False,
    calendar=False,
    category_stats=False,
    category_means=(),
    versus_mean=False,
    min_vs_max=False,
)
_RANKED = ("o_totalprice", "o_totalprice_min", "o_totalprice_max", "o_totalprice_first", "o_totalprice_mid_gt2")
_FLAGS = [("status", v) for v in (1, 2)] + [("priority", v) for v in (2, 3, 4, 5)]
_B = f"{BOUND!r}::DOUBLE"


def _score_sql(c: str) -> str:
    rank = f"least(greatest((r_{c} - 1) / nullif((max(r_{c}) OVER () - 1) / 2.0::DOUBLE * {_B}, 0) - {_B}, -{_B}), {_B})"
    return f"({rank}) AS s_{c}"


@query(
    "network_inputs",
    "SELECT o_custkey, "
    + ", ".join(f"CASE WHEN {c} = {v} THEN 1 ELSE 0 END AS {c}_{v}" for c, v in _FLAGS)
    + ", "
    + ", ".join(f"round({erfinv_sql(f's_{c}')}, 9) AS {c}" for c in _RANKED)
    + " FROM (SELECT o_custkey, status, priority, "
    + ", ".join(_score_sql(c) for c in _RANKED)
    + " FROM (SELECT *, "
    + ", ".join(f"dense_rank() OVER (ORDER BY coalesce({c}, -1)) AS r_{c}" for c in _RANKED)
    + f" FROM ({feature_sql(ORDERS, EXACT)})))",
)
def network_inputs(spark, sf_dir):
    """What the network is fed: filled row, category flags, Gaussian ranks."""
    rows = network_row(orders(spark, sf_dir), ORDERS, EXACT, new_path(spark, "categories"))
    knots = materialise(fit_gauss_rank(rows, _RANKED), "knots")
    flags = [f"{c}_{v}" for c, v in _FLAGS]
    return rounded(gauss_rank(rows, knots, _RANKED, ["o_custkey"]).select("o_custkey", *flags, *_RANKED), 9)
