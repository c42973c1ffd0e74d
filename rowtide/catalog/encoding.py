"""Queries for one-hot encoding and scalers."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.catalog import query
from rowtide.catalog.fixtures import (
    EVENTS_SQL,
    LINES,
    ORDERS,
    events,
    lines,
    numbered_sql,
    rounded,
    table,
)
from rowtide.functions.numeric import _CENTRE, _SHOULDER
from rowtide.operators import blocks
from rowtide.operators.encode import apply_one_hot, fit_one_hot, load_categories, save_categories
from rowtide.operators.positions import with_ordinals
from rowtide.operators.scale import (
    BOUND,
    fit_gauss_rank,
    fit_standard,
    gauss_rank,
    gauss_rank_inverse,
    standard_scale,
)
from rowtide.session import materialise, new_path

_FLAGS = [("o_orderstatus", v) for v in ("O", "P")] + [
    ("o_orderpriority", v) for v in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
]


@query(
    "one_hot",
    "SELECT o_custkey, o_orderkey, "
    + ", ".join(f"""CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS "{c}_{v}\"""" for c, v in _FLAGS)
    + " FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, "
    "o_orderkey DESC) AS back FROM orders) WHERE back = 1",
)
def one_hot(spark, sf_dir):
    cols = ["o_orderstatus", "o_orderpriority"]
    df = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", *cols)
    last = blocks.aggregate(
        with_ordinals(df, ORDERS), "o_custkey", blocks.last_row(["o_orderkey", *cols])
    )
    path = new_path(spark, "categories")
    save_categories(fit_one_hot(last, cols), path)
    return apply_one_hot(last, load_categories(spark, path), cols)


def _knots_sql(c: str, source: str) -> str:
    """Distinct values of one column with their scaled rank."""
    b = f"{BOUND!r}::DOUBLE"
    rank = "(row_number() OVER (ORDER BY value) - 1)"
    scaled = f"{rank} / nullif((count(*) OVER () - 1) / 2.0::DOUBLE * {b}, 0) - {b}"
    return (
        f"SELECT '{c}' AS feature, value, least(greatest({scaled}, -{b}), {b}) AS s FROM "
        f"(SELECT DISTINCT CAST({c} AS DOUBLE) AS value FROM ({source}) WHERE {c} IS NOT NULL)"
    )


@query(
    "gauss_rank_fit",
    " UNION ALL ".join(
        f"SELECT feature, value, round(s, 9) AS s FROM ({_knots_sql(c, 'SELECT * FROM lineitem')})"
        for c in LINES.numeric
    ),
)
def gauss_rank_fit(spark, sf_dir):
    return fit_gauss_rank(lines(spark, sf_dir), LINES.numeric).withColumn("s", F.round("s", 9))


def _polynomial(coefficients, x: str) -> str:
    out = repr(coefficients[-1])
    for k in reversed(coefficients[:-1]):
        out = f"({out} * ({x}) + {k!r}::DOUBLE)"
    return out


def erfinv_sql(x: str) -> str:
    """Same rational approximation as the engine, for |x| <= 1 - 1e-4."""
    q = f"({x} / 2)"
    near = f"(0.180625::DOUBLE - {q} * {q})"
    r = f"(sqrt(-ln(0.5::DOUBLE - abs({q}))) - 1.6::DOUBLE)"
    centre = f"{q} * {_polynomial(_CENTRE[0], near)} / {_polynomial(_CENTRE[1], near)}"
    outer = f"sign({q}) * {_polynomial(_SHOULDER[0], r)} / {_polynomial(_SHOULDER[1], r)}"
    return f"(CASE WHEN abs({q}) <= 0.425 THEN {centre} ELSE {outer} END / sqrt(2.0::DOUBLE))"


_EVENT_KNOTS = _knots_sql("value", EVENTS_SQL)


def _scaled_sql(queries: str, knots: str) -> str:
    """Interpolated rank of each ``value`` of ``queries`` (event_id, value); no value, no rank."""
    between = (
        "SELECT q.event_id, q.value AS x, lo.value AS x0, lo.s AS y0, hi.value AS x1, hi.s AS y1 "
        f"FROM ({queries}) q ASOF LEFT JOIN ({knots}) lo ON q.value >= lo.value "
        f"ASOF LEFT JOIN ({knots}) hi ON q.value <= hi.value"
    )
    return (
        f"SELECT event_id, x, CASE WHEN x IS NULL THEN NULL WHEN x0 IS NULL THEN -{BOUND!r} WHEN x1 IS NULL THEN {BOUND!r} "
        f"WHEN x0 = x1 THEN y0 ELSE y0 + (x - x0) * ((y1 - y0) / (x1 - x0)) END::DOUBLE AS s FROM ({between})"
    )


_EVENT_SCALED = _scaled_sql("SELECT event_id, value FROM events", _EVENT_KNOTS)


def _fitted(spark, sf_dir):
    """Knots of the panel with holes; every event is then transformed, also values never seen."""
    return materialise(fit_gauss_rank(events(spark, sf_dir), ["value"]), "knots")


@query("gauss_rank", f"SELECT event_id, round({erfinv_sql('s')}, 9) AS value FROM ({_EVENT_SCALED})")
def gauss_rank_rows(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "value")
    return rounded(gauss_rank(df, _fitted(spark, sf_dir), ["value"], ["event_id"]), 9)


# NaN, both infinities, and values beyond the outer knots.
_EDGES = (
    "CASE event_id % 13 WHEN 0 THEN {nan} WHEN 1 THEN {inf} WHEN 2 THEN -{inf} WHEN 3 THEN -5.0 - event_id "
    "WHEN 4 THEN 1e9 + event_id ELSE value END"
)
_SPARK_EDGES = _EDGES.format(nan="double('NaN')", inf="double('Infinity')")
_SQL_EDGES = _EDGES.format(nan="NULL::DOUBLE", inf="NULL::DOUBLE")
_EDGE_ROWS = f"SELECT event_id, {_SQL_EDGES} AS value FROM events"
_EDGE_KNOTS = _knots_sql("value", f"SELECT {_SQL_EDGES} AS value FROM events WHERE event_id % 3 != 0")


@query(
    "gauss_rank_edges",
    f"SELECT event_id, round({erfinv_sql('s')}, 9) AS value FROM ({_scaled_sql(_EDGE_ROWS, _EDGE_KNOTS)})",
)
def gauss_rank_edges(spark, sf_dir):
    """Missing and infinite values have no score and are no knots."""
    df = table(spark, sf_dir, "events").selectExpr("event_id", f"{_SPARK_EDGES} AS value")
    knots = materialise(fit_gauss_rank(df.filter("event_id % 3 != 0"), ["value"]), "knots")
    return rounded(gauss_rank(df, knots, ["value"], ["event_id"]), 9)


_SCALED_MANY = {"value": "value", "half": "value / 2 + event_id % 7", "root": "sqrt(value)"}
_MANY_SQL = "SELECT event_id, " + ", ".join(f"{e} AS {n}" for n, e in _SCALED_MANY.items()) + " FROM ({})"


@query(
    "gauss_rank_many",
    "SELECT event_id, "
    + ", ".join(f"round({erfinv_sql(f'{n}_s')}, 9) AS {n}" for n in _SCALED_MANY)
    + " FROM "
    + " JOIN ".join(
        "(SELECT event_id, s AS {n}_s FROM ({sql})) t_{n}".format(
            n=n,
            sql=_scaled_sql(
                f"SELECT event_id, {n} AS value FROM ({_MANY_SQL.format('SELECT * FROM events')})",
                _knots_sql("value", f"SELECT {n} AS value FROM ({_MANY_SQL.format(EVENTS_SQL)})"),
            ),
        )
        + (" USING (event_id)" if i else "")
        for i, n in enumerate(_SCALED_MANY)
    ),
)
def gauss_rank_many(spark, sf_dir):
    shown = ["event_id", *[f"{e} AS {n}" for n, e in _SCALED_MANY.items()]]
    knots = materialise(fit_gauss_rank(events(spark, sf_dir).selectExpr(*shown), list(_SCALED_MANY)), "knots")
    df = table(spark, sf_dir, "events").selectExpr(*shown)
    return rounded(gauss_rank(df, knots, list(_SCALED_MANY), ["event_id"]), 9)


@query(
    "gauss_rank_inverse",
    f"WITH k AS ({_EVENT_KNOTS}), edge AS (SELECT min(value) AS low, "
    f"min(value) FILTER (WHERE s >= {BOUND!r}) AS high FROM k) "
    f"SELECT event_id, round(CASE WHEN s >= {BOUND!r} THEN high WHEN s <= -{BOUND!r} THEN low ELSE x END, 5) "
    f"AS value FROM ({_EVENT_SCALED}), edge",
)
def gauss_rank_inverse_rows(spark, sf_dir):
    knots = _fitted(spark, sf_dir)
    df = table(spark, sf_dir, "events").select("event_id", "value")
    scaled = gauss_rank(df, knots, ["value"], ["event_id"])
    return rounded(gauss_rank_inverse(scaled, knots, ["value"], ["event_id"]), 5)


_LAST_LINES = f"SELECT * FROM ({numbered_sql(LINES)}) WHERE rn = n"


@query(
    "standard_scale",
    "SELECT l_suppkey, "
    + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / (CASE stddev_pop({c}) OVER () WHEN 0 THEN 1 "
        f"ELSE stddev_pop({c}) OVER () END), 6) AS {c}"
        for c in LINES.numeric
    )
    + f" FROM ({_LAST_LINES})",
)
def standard_scale_rows(spark, sf_dir):
    last = blocks.aggregate(
        with_ordinals(lines(spark, sf_dir), LINES), "l_suppkey", blocks.last_row(LINES.numeric)
    )
    params = materialise(fit_standard(last, LINES.numeric), "centres")
    return rounded(standard_scale(last, params, LINES.numeric))
