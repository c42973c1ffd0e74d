"""Power transformer (Yeo-Johnson): each column to the power that makes it most normal.

The power of a column maximises the log-likelihood of its transformed values. Its first and second
derivatives follow from variances and covariances of the transformed values and of their own
derivatives, so one aggregation gives a Newton step for all columns at once. Steps are safeguarded: the sign of the
first derivative keeps a bracket, and a step that leaves it, or that goes the wrong way, becomes a halving of it. Only a few numbers
a column come to the driver.

Missing and infinite values take no part and stay missing. A column without spread keeps power 1.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isfinite

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.text import name
from rowtide.session import materialise

BRACKET = (-8.0, 10.0)  # powers that are looked at
CLOSE = 1e-10
STEPS = 80
_NEAR = 1e-2  # of |power x log|, below which the closed forms lose digits


_SERIES = (
    "(1 + {z} / 2 * (1 + {z} / 3 * (1 + {z} / 4 * (1 + {z} / 5))))",
    "(1D / 2 + {z} * (1D / 3 + {z} * (1D / 8 + {z} * (1D / 30 + {z} / 144))))",
    "(1D / 3 + {z} * (1D / 4 + {z} * (1D / 10 + {z} * (1D / 36 + {z} / 168))))",
)


def _raised(p: str, g: str) -> tuple[str, str, str]:
    """((1 + x)^p - 1) / p with g = log(1 + x), and its first and second derivative by p.

    With z = p g these are g e1(z), g² e2(z), g³ e3(z); near 0 the functions are their series.
    """
    z = f"({p} * {g})"
    whole = (
        f"expm1({z}) / {z}",
        f"({z} * exp({z}) - expm1({z})) / ({z} * {z})",
        f"(({z} * {z} - 2 * {z}) * exp({z}) + 2 * expm1({z})) / ({z} * {z} * {z})",
    )
    powers = (g, f"{g} * {g}", f"{g} * {g} * {g}")
    return tuple(f"({k} * CASE WHEN abs({z}) < {_NEAR} THEN {s.format(z=z)} ELSE {w} END)" for k, s, w in zip(powers, _SERIES, whole, strict=True))


def _from_logs() -> tuple[str, str, str]:
    """The same of rows that hold t, z and e = expm1(z); the sign of t is that of the value."""
    # Below zero the power counts down from 2: the value and its second derivative change their sign.
    powers = ("t", "t * t", "t * t * t")
    whole = ("e / z", "(z * (e + 1) - e) / (z * z)", "((z * z - 2 * z) * (e + 1) + 2 * e) / (z * z * z)")
    return tuple(f"({k} * CASE WHEN abs(z) < {_NEAR} THEN {s.format(z='z')} ELSE {w} END)" for k, s, w in zip(powers, _SERIES, whole, strict=True))


def yeo_johnson(x: str, power: str) -> tuple[str, str, str]:
    """SQL of the transformed value and its first two derivatives by the power."""
    up, down = _raised(power, f"log1p({x})"), _raised(f"(2D - {power})", f"log1p(-{x})")
    signs = ("-", "", "-")  # below zero the power counts down from 2
    return tuple(f"CASE WHEN {x} >= 0 THEN {a} ELSE {s}{b} END" for a, b, s in zip(up, down, signs, strict=True))


def fit_power(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Table (feature, power, centre, scale): the transform and what standardises it."""
    spark = df.sparkSession
    cells = F.array(*[F.col(name(c)).cast("double") for c in columns])
    rows = df.select(F.posexplode(cells).alias("at", "x")).filter("abs(x) < double('Infinity')")
    # All that the transform asks of a value: its logarithm, below zero with a minus.
    rows = materialise(rows.selectExpr("at", "CASE WHEN x >= 0 THEN log1p(x) ELSE -log1p(-x) END AS t"), "power-cells")
    fixed = _fixed(rows)
    total = sum(r["n"] for r in fixed.values())
    starts: dict[int, float] = {}
    if total > _AHEAD * len(columns):
        # Where to begin, from some of the rows: the steps over all rows are few then, and end as close as from anywhere else.
        some = materialise(rows.sample(_AHEAD * len(columns) / total, seed=7), "power-ahead")
        starts = _solved(some, _fixed(some), {}, _ABOUT)
    powers = {i: 1.0 for i in range(len(columns))} | _solved(rows, fixed, starts, CLOSE)
    return _standardised(spark, rows, list(columns), powers)


_AHEAD = 200_000  # cells a column from which the first guess is taken
_ABOUT = 1e-5  # how close that guess is to the power of its cells


def _fixed(rows: DataFrame) -> dict[int, Row]:
    """Of each column the number of its values, the sum of their logarithms, and the extremes."""
    sums = rows.groupBy("at").agg(F.count("*").alias("n"), F.sum("t").alias("logs"), F.min("t").alias("low"), F.max("t").alias("high"))
    return {r["at"]: r for r in sums.collect()}


def _solved(rows: DataFrame, fixed: dict[int, Row], starts: dict[int, float], close: float) -> dict[int, float]:
    """The powers of the columns that have spread."""
    state = {i: [*BRACKET, starts.get(i, 1.0)] for i, r in fixed.items() if r["low"] < r["high"]}
    done: dict[int, float] = {}
    for _ in range(STEPS):
        open_ = {i: s for i, s in state.items() if i not in done}
        if not open_:
            break
        for i, (n, v, d1, d2, c2) in _moments(rows, {i: s[2] for i, s in open_.items()}).items():
            # log-likelihood = -n/2 log(variance) + (power - 1) * logs
            first = -n / 2 * (2 * d1 / v) + fixed[i]["logs"]
            second = -n / 2 * (2 * (d2 + c2) / v - (2 * d1 / v) ** 2)
            low, high, at = state[i]
            if first > 0:
                low = at
            else:
                high = at
            step = at - first / second if second < 0 and isfinite(first / second) else None
            new = step if step is not None and low < step < high else (low + high) / 2
            state[i] = [low, high, new]
            if abs(new - at) <= close * max(1.0, abs(at)):
                done[i] = new
    return {i: done.get(i, s[2]) for i, s in state.items()}


def _with_power(rows: DataFrame, powers: dict[int, float]) -> DataFrame:
    """``rows`` with z, the power times the logarithm, and e = expm1(z), each made once."""
    listed = ", ".join(f"{powers[i]!r}D" if i in powers else "CAST(NULL AS DOUBLE)" for i in range(max(powers) + 1))
    known = rows.selectExpr("*", f"get(array({listed}), at) AS p").filter("p IS NOT NULL")
    return known.selectExpr("at", "t", "(CASE WHEN t >= 0 THEN p ELSE 2D - p END) * abs(t) AS z").selectExpr("*", "expm1(z) AS e")


def _moments(rows: DataFrame, powers: dict[int, float]) -> dict[int, tuple[float, ...]]:
    """n, variance of y, covariance (y, y'), variance of y', covariance (y, y'') of each open column."""
    y, y1, y2 = _from_logs()
    shown = _with_power(rows, powers).selectExpr("at", f"{y} AS y", f"{y1} AS y1", f"{y2} AS y2")
    sums = ("count(*) AS n", "var_pop(y) AS v", "covar_pop(y, y1) AS d1", "var_pop(y1) AS d2", "covar_pop(y, y2) AS c2")
    return {r["at"]: (r["n"], r["v"], r["d1"], r["d2"], r["c2"]) for r in shown.groupBy("at").agg(*[F.expr(s) for s in sums]).collect()}


def _standardised(spark: SparkSession, rows: DataFrame, columns: list[str], powers: dict[int, float]) -> DataFrame:
    shown = _with_power(rows, powers).selectExpr("at", f"{_from_logs()[0]} AS y")
    stats = {r["at"]: r for r in shown.groupBy("at").agg(F.avg("y").alias("m"), F.stddev_pop("y").alias("s")).collect()}
    out = []
    for i, c in enumerate(columns):
        r = stats.get(i)
        out.append((c, powers[i], r["m"] if r else None, (r["s"] or 1.0) if r else None))
    return spark.createDataFrame(out, "feature string, power double, centre double, scale double")


def power_transform(df: DataFrame, fitted: DataFrame, columns: Sequence[str], standardise: bool = True) -> DataFrame:
    """Replace ``columns`` by their transformed values, standardised unless told otherwise."""
    found = {r["feature"]: r for r in fitted.collect()}
    out = {}
    for c in columns:
        r, x = found[c], f"CAST({name(c)} AS DOUBLE)"
        if r["centre"] is None:
            out[c] = "CAST(NULL AS DOUBLE)"
            continue
        y = yeo_johnson(x, f"{r['power']!r}D")[0]
        y = f"({y} - {r['centre']!r}D) / {r['scale']!r}D" if standardise else y
        out[c] = f"CASE WHEN abs({x}) < double('Infinity') THEN {y} END"
    return df.selectExpr(*[f"{out[c]} AS {name(c)}" if c in out else name(c) for c in df.columns])
