"""Queries for quantile, power and polynomial transformers, target encoding, importance and growing feature tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from rowtide.catalog import query
from rowtide.catalog.features import TREES
from rowtide.catalog.fixtures import ORDERS, ORDERS_SQL, as_doubles, orders, rounded, table
from rowtide.catalog.models import export, exported, parts_sql, tree_run
from rowtide.catalog.sqlfeatures import feature_sql, filled_sql
from rowtide.catalog.training import FOLDED
from rowtide.operators.folds import stratified_folds
from rowtide.operators.polynomial import exponent_table, feature_name, polynomial, sparse_pairs
from rowtide.operators.power import BRACKET, fit_power, power_transform
from rowtide.operators.quantile import fit_quantiles, quantile_transform
from rowtide.operators.target_encode import encode_target, fit_target_encoding
from rowtide.plans.importance import permutation_importance
from rowtide.plans.increment import FeatureTable
from rowtide.plans.models import node_table
from rowtide.session import materialise, new_path

_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "value")
_STEPS = 41
# Gaps, and a value that half of the rows share.
_SHARED = "CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 2 = 0 THEN 7.0 ELSE l_extendedprice - 900.0 END"
_LINES_SQL = f"SELECT {_KEY}, l_quantity, l_extendedprice, l_discount, {_SHARED} AS value FROM lineitem"


def _measured(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(*_KEY.split(", "), "l_quantity", "l_extendedprice", "l_discount", f"CAST({_SHARED} AS DOUBLE) AS value")


_REFERENCES = "[" + ", ".join(f"{i / (_STEPS - 1)!r}" for i in range(_STEPS)) + "]"


def _quantiles_sql(c: str) -> str:
    return f"SELECT quantile_cont({c}::DOUBLE, {_REFERENCES}) AS q FROM ({_LINES_SQL})"


@query(
    "quantile_fit",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(i AS INT) AS step, round(i / {_STEPS - 1}.0::DOUBLE, 9) AS reference, round(q[i + 1], 9) AS value "
        f"FROM ({_quantiles_sql(c)}), range({_STEPS}) t(i)"
        for c in _NUMERIC
    ),
)
def quantile_fit(spark, sf_dir):
    return rounded(fit_quantiles(_measured(spark, sf_dir), _NUMERIC, _STEPS), 9)


def _placed_sql(c: str) -> str:
    """A column's place among its quantiles ``q_{c}``."""
    q, x, r = f"q_{c}", f"{c}::DOUBLE", f"({_REFERENCES})"
    below, upto = f"len(list_filter({q}, lambda v: v < {x}))", f"len(list_filter({q}, lambda v: v <= {x}))"
    between = f"{r}[{upto}] + ({x} - {q}[{upto}]) * (({r}[{upto} + 1] - {r}[{upto}]) / ({q}[{upto} + 1] - {q}[{upto}]))"
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= {q}[1] THEN 0.0 WHEN {x} >= {q}[-1] THEN 1.0 "
        f"WHEN {below} < {upto} THEN ({r}[{below} + 1] + {r}[{upto}]) / 2 ELSE {between} END"
    )


@query(
    "quantile_uniform",
    f"SELECT {_KEY}, {', '.join(f'round({_placed_sql(c)}, 9) AS {c}' for c in _NUMERIC)} FROM ({_LINES_SQL}), "
    + ", ".join(f"(SELECT q AS q_{c} FROM ({_quantiles_sql(c)}))" for c in _NUMERIC),
)
def quantile_uniform(spark, sf_dir):
    rows = _measured(spark, sf_dir)
    fitted = materialise(fit_quantiles(rows, _NUMERIC, _STEPS), "quantiles")
    return rounded(quantile_transform(rows, fitted, _NUMERIC), 9)


_POWERED = ("l_quantity", "l_extendedprice", "centred")
_POWER_SQL = f"SELECT {_KEY}, l_quantity::DOUBLE AS l_quantity, l_extendedprice::DOUBLE / 1000 AS l_extendedprice, (l_quantity - 20)::DOUBLE / 8 AS centred FROM lineitem"


def _raised_sql(x: str, p: str) -> str:
    up = f"CASE WHEN abs({p}) < 1e-12 THEN ln(1 + {x}) ELSE (pow(1 + {x}, {p}) - 1) / {p} END"
    down = f"CASE WHEN abs(2 - {p}) < 1e-12 THEN -ln(1 - {x}) ELSE -(pow(1 - {x}, 2 - {p}) - 1) / (2 - {p}) END"
    return f"CASE WHEN {x} >= 0 THEN {up} ELSE {down} END"


def _power_sql(c: str) -> str:
    """The power of a column: grids of the log-likelihood around the best power so far, each finer than the last."""
    logs = f"sum(CASE WHEN {c} >= 0 THEN ln(1 + {c}) ELSE -ln(1 - {c}) END)"
    # Equal values are one row with their number.
    data = f"SELECT {c} AS x, count(*)::DOUBLE AS w FROM ({_POWER_SQL}) GROUP BY 1"
    best, step = f"SELECT {sum(BRACKET) / 2}::DOUBLE AS p", (BRACKET[1] - BRACKET[0]) / 40
    parts = [f"d AS MATERIALIZED ({data})", f"l AS MATERIALIZED (SELECT {logs} AS logs, count(*)::DOUBLE AS n FROM ({_POWER_SQL}))", f"p0 AS ({best})"]
    for i in range(1, 6):
        grid = f"SELECT p + i * {step!r}::DOUBLE AS p FROM p{i - 1}, range(-20, 21) t(i)"
        y = _raised_sql("x", "p")
        mean = f"SELECT p, x, w, {y} AS y FROM d, ({grid})"
        centred = f"SELECT p, w, y - sum(w * y) OVER g / sum(w) OVER g AS y FROM ({mean}) WINDOW g AS (PARTITION BY p)"
        seen = f"SELECT p, -n / 2 * ln(sum(w * y * y) / n) + (p - 1) * logs AS ll FROM ({centred}), l GROUP BY p, n, logs"
        parts.append(f"p{i} AS MATERIALIZED (SELECT arg_max(p, ll) AS p FROM ({seen}))")
        step /= 10
    # Near the top the log-likelihood is a parabola: its vertex from three points.
    step *= 100
    three = f"SELECT i, p, p + i * {step!r}::DOUBLE AS q FROM p5, range(-1, 2) t(i)"
    y = _raised_sql("x", "q")
    centred = f"SELECT i, p, q, w, y - sum(w * y) OVER g / sum(w) OVER g AS y FROM (SELECT i, p, q, x, w, {y} AS y FROM d, ({three})) WINDOW g AS (PARTITION BY i)"
    lls = f"SELECT i, p, -n / 2 * ln(sum(w * y * y) / n) + (q - 1) * logs AS ll FROM ({centred}), l GROUP BY i, p, q, n, logs"
    a, b, z = (f"max(ll) FILTER (WHERE i = {k})" for k in (-1, 0, 1))
    vertex = f"SELECT max(p) + {step!r} / 2 * (({a}) - ({z})) / (({a}) - 2 * ({b}) + ({z})) AS p FROM ({lls})"
    return f"(WITH {', '.join(parts)} {vertex})"


@query(
    "power_fit",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, round(p, 5) AS power FROM {_power_sql(c)}" for c in _POWERED),
)
def power_fit(spark, sf_dir):
    rows = _powered_rows(spark, sf_dir)
    return rounded(fit_power(rows, _POWERED).select("feature", "power"), 5)


def _powered_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        *_KEY.split(", "), "CAST(l_quantity AS DOUBLE) AS l_quantity", "l_extendedprice / 1000D AS l_extendedprice", "CAST(l_quantity - 20 AS DOUBLE) / 8D AS centred"
    )


@query(
    "power_transform",
    f"SELECT {_KEY}, "
    + ", ".join(
        f"round(({_raised_sql(c, f'p_{c}')} - c_{c}) / s_{c}, 9) AS {c}" for c in _POWERED
    )
    + f" FROM ({_POWER_SQL}), (SELECT "
    + ", ".join(f"max({v}) FILTER (WHERE feature = '{c}') AS {k}_{c}" for c in _POWERED for k, v in (("p", "power"), ("c", "centre"), ("s", "scale")))
    + f" FROM {exported('power_transform')})",
)
def power_transformed(spark, sf_dir):
    """Transformed and standardised columns; ``power_fit`` is about the powers themselves."""
    rows = _powered_rows(spark, sf_dir)
    fitted = materialise(fit_power(rows, _POWERED), "powers")
    export(fitted, "power_transform")
    return rounded(power_transform(rows, fitted, _POWERED), 9)


_POLY = ("o_totalprice", "status", "priority")
_POLY_SQL = f"SELECT o_custkey, o_orderkey, o_totalprice / 1000 AS o_totalprice, status, CASE WHEN o_orderkey % 7 <> 0 THEN priority END AS priority FROM ({ORDERS_SQL})"


def _poly_rows(spark, sf_dir):
    shown = "CASE WHEN o_orderkey % 7 <> 0 THEN priority END AS priority"
    return orders(spark, sf_dir).selectExpr("o_custkey", "o_orderkey", "o_totalprice / 1000 AS o_totalprice", "status", shown)


def _poly_sql(**options) -> str:
    terms = exponent_table(_POLY, **options)
    shown = [f"round({' * '.join(f'{c}::DOUBLE' for c, p in t for _ in range(p)) or '1.0::DOUBLE'}, 6) AS \"{feature_name(t)}\"" for t in terms]
    return f"SELECT o_custkey, o_orderkey, {', '.join(shown)} FROM ({_POLY_SQL})"


@query("polynomial_2", _poly_sql(degree=2, bias=True))
def polynomial_2(spark, sf_dir):
    return rounded(polynomial(_poly_rows(spark, sf_dir), _POLY, 2, bias=True))


@query("polynomial_interactions", _poly_sql(degree=3, interactions_only=True))
def polynomial_interactions(spark, sf_dir):
    return rounded(polynomial(_poly_rows(spark, sf_dir), _POLY, 3, interactions_only=True))


@query(
    "polynomial_sparse",
    " UNION ALL ".join(
        f"SELECT o_orderkey, {i} AS place, '{feature_name(t)}' AS feature, round({' * '.join(f'{c}::DOUBLE' for c, p in t for _ in range(p))}, 6) AS value "
        f"FROM ({_POLY_SQL}) WHERE {' AND '.join(f'{c} <> 0' for c, _ in t)}"
        for i, t in enumerate(exponent_table(_POLY, 2))
    ),
)
def polynomial_sparse(spark, sf_dir):
    return rounded(sparse_pairs(_poly_rows(spark, sf_dir), _POLY, ["o_orderkey"]))


_SMOOTHING = 5.0
_CATEGORIES = ("o_orderpriority", "clerk")
_ENCODED_SQL = (
    "SELECT o_orderkey, o_orderpriority, CASE WHEN o_custkey % 9 <> 0 THEN o_custkey % 40 END AS clerk, "
    "CASE WHEN o_orderkey % 13 <> 0 THEN CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END END AS target FROM orders"
)
_ENCODED_FOLDS = (
    "SELECT *, CAST((row_number() OVER (PARTITION BY target ORDER BY md5('42:' || o_orderkey), o_orderkey) - 1) % 5 AS INT) AS fold "
    f"FROM ({_ENCODED_SQL})"
)


def _encoding_sql(c: str) -> str:
    own = f"PARTITION BY {c}"
    t, n = f"sum(target) OVER ({own}) - sum(target) OVER ({own}, fold)", f"count(target) OVER ({own}) - count(target) OVER ({own}, fold)"
    mean = "(sum(target) OVER () - sum(target) OVER (PARTITION BY fold)) / (count(target) OVER () - count(target) OVER (PARTITION BY fold))"
    zero = f"coalesce({t.replace(f'sum(target) OVER ({own}, fold)', f'coalesce(sum(target) OVER ({own}, fold), 0)')}, 0)"
    return f"round((({zero})::DOUBLE + {_SMOOTHING} * {mean}) / (({n}) + {_SMOOTHING}), 9) AS {c}_target"


@query(
    "target_encoding",
    f"SELECT o_orderkey, fold, target, {', '.join(_encoding_sql(c) for c in _CATEGORIES)} FROM ({_ENCODED_FOLDS})",
)
def target_encoding(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_orderpriority",
        "CASE WHEN o_custkey % 9 <> 0 THEN o_custkey % 40 END AS clerk",
        "CASE WHEN o_orderkey % 13 <> 0 THEN CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END END AS target",
    )
    folded = materialise(stratified_folds(rows, "o_orderkey", "target", derived=True), "folded")
    fitted = materialise(fit_target_encoding(folded, _CATEGORIES, "target", _SMOOTHING), "encoding")
    out = encode_target(folded, fitted, _CATEGORIES)
    return rounded(out.select("o_orderkey", "fold", "target", *[f"{c}_target" for c in _CATEGORIES]), 9)


GROWING = replace(TREES, middle=(), middle_gt2=())


@query("incremental_features", filled_sql(feature_sql(ORDERS, GROWING), "o_custkey"))
def incremental_features(spark, sf_dir):
    """Three loads whose rows are out of order, one of them sent twice."""
    rows = orders(spark, sf_dir)
    grown = FeatureTable(spark, new_path(spark, "growing"), ORDERS, GROWING)
    for part in (1, 0, 1, 2):
        grown.load(rows.filter(F.col("o_orderkey") % 3 == part), f"part-{part}")
    return as_doubles(grown.features(), "o_custkey")


_SEED = 42


def _importance_sql(nodes: str) -> str:
    """Every row of every fold, with each feature in turn taken from its donor."""
    rank = "row_number() OVER (PARTITION BY fold ORDER BY md5('{}:' || o_custkey), o_custkey) AS r"
    folded = f"SELECT o_custkey, target, fold FROM ({FOLDED})"
    donors = (
        f"SELECT a.o_custkey, b.o_custkey AS donor FROM (SELECT *, {rank.format(2 * _SEED + 1)} FROM ({folded})) a "
        f"JOIN (SELECT *, {rank.format(2 * _SEED + 2)} FROM ({folded})) b ON a.fold = b.fold AND a.r = b.r"
    )
    base = parts_sql(f"SELECT o_custkey, fold FROM ({FOLDED})", nodes)
    head, _, tail = base.partition(", walk AS (")
    walk = (
        "SELECT r.o_custkey, r.fold, t.feature AS shuffled, n.tree, n.node FROM f r JOIN nodes n ON n.fold = r.fold AND n.node = 0, "
        "(SELECT DISTINCT feature FROM nodes WHERE below >= 0 UNION ALL SELECT NULL) t "
        "UNION ALL SELECT w.o_custkey, w.fold, w.shuffled, w.tree, CASE WHEN x.x <= n.threshold THEN n.below ELSE n.above END "
        "FROM walk w JOIN nodes n ON n.fold = w.fold AND n.tree = w.tree AND n.node = w.node JOIN donors d ON d.o_custkey = w.o_custkey "
        "JOIN feats x ON x.feature = n.feature AND x.o_custkey = CASE WHEN n.feature = w.shuffled THEN d.donor ELSE w.o_custkey END WHERE n.below >= 0"
    )
    margins = (
        "SELECT w.o_custkey, w.fold, w.shuffled, f.target, round(sum(n.weight * n.value), 9) AS margin FROM walk w "
        "JOIN nodes n ON n.fold = w.fold AND n.tree = w.tree AND n.node = w.node JOIN f ON f.o_custkey = w.o_custkey "
        "WHERE n.below < 0 GROUP BY ALL"
    )
    by = "PARTITION BY fold, shuffled"
    weighed = (
        "SELECT *, sum(weight) OVER o AS cum_weight, sum(target) OVER o AS cum_pos, sum(weight) OVER g AS total, "
        f"sum(target) OVER g AS p, sum(1 - target) OVER g AS n FROM (SELECT *, 20 - 19 * target AS weight FROM ({margins})) "
        f"WINDOW o AS ({by} ORDER BY margin DESC, o_custkey ROWS UNBOUNDED PRECEDING), g AS ({by})"
    )
    scores = (
        "SELECT fold, shuffled, round(0.5::DOUBLE * (raw / (10 * n * (p + 20 * n - 19) / (p + 20 * n)) + captured / p), 9) AS score "
        "FROM (SELECT fold, shuffled, max(p)::DOUBLE AS p, max(n)::DOUBLE AS n, "
        "sum((cum_pos::DOUBLE / p::DOUBLE - cum_weight::DOUBLE / total::DOUBLE) * weight) AS raw, "
        "count(*) FILTER (WHERE target = 1 AND cum_weight <= floor(0.04::DOUBLE * total::DOUBLE))::DOUBLE AS captured "
        f"FROM ({weighed}) GROUP BY fold, shuffled)"
    )
    listed = "SELECT DISTINCT feature FROM feats"
    return (
        f"{head}, f AS MATERIALIZED ({folded}), donors AS MATERIALIZED ({donors}), walk AS ({walk}), scores AS MATERIALIZED ({scores}) "
        "SELECT b.fold, l.feature, coalesce(s.score, b.score) AS score, b.score AS base, round(b.score - coalesce(s.score, b.score), 9) AS importance "
        f"FROM (SELECT fold, score FROM scores WHERE shuffled IS NULL) b CROSS JOIN ({listed}) l "
        "LEFT JOIN scores s ON s.fold = b.fold AND s.shuffled = l.feature"
    )


@query("permutation_importance", _importance_sql("permutation_importance"))
def importance(spark, sf_dir):
    train, _, spec = tree_run(spark, sf_dir, "metric")
    export(node_table(spark, spec), "permutation_importance")
    return permutation_importance(train, spec, seed=_SEED)
