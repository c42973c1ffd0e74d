"""The panels that queries run on, in Spark and as SQL with the same name and columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.sources.panel import read_panel
from rowtide.spec import PanelSpec

EVENTS = PanelSpec("user_id", ("ts", "event_id"), ("value",), ("event_type",))
ORDERS = PanelSpec(
    "o_custkey",
    ("o_orderdate", "o_orderkey"),
    ("o_totalprice",),
    ("status", "priority"),
    {"spend": ("o_totalprice",)},
)
LINES = PanelSpec(
    "l_suppkey",
    ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"),
    ("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    ("flag", "state"),
    {
        "spend": ("l_quantity",),
        "balance": ("l_extendedprice",),
        "payment": ("l_discount",),
        "delinquency": ("l_tax",),
    },
)

# A panel as wide as the real one: columns of exact numbers with gaps, made from the lines' keys.
FULL_WIDTH = 190
FULL = PanelSpec(
    "supplier",
    ("shipped", "l_orderkey", "l_linenumber", "l_partkey"),
    tuple(f"n{i:03}" for i in range(FULL_WIDTH)),
    ("flag", "state"),
    {"spend": tuple(f"n{i:03}" for i in range(0, FULL_WIDTH, 10))},
)

# Category codes, the same in both engines.
STATUS = "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"
PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS INT)"
FLAG = "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"
STATE = "CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END"
HOLES = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END"
LOGIT = "1 / (1 + exp(-(value - 50) / 100))"

EVENTS_SQL = f"SELECT user_id, ts, event_id, event_type, {HOLES} AS value FROM events"
ORDERS_SQL = (
    f"SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, {STATUS} AS status, "
    f"{PRIORITY} AS priority FROM orders"
)
LINES_SQL = (
    "SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, "
    f"l_extendedprice, l_discount, l_tax, {FLAG} AS flag, {STATE} AS state FROM lineitem"
)
SCORED_SQL = (
    "SELECT event_id, value AS score, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS target, "
    f"{LOGIT} AS probability FROM events"
)

def full_columns() -> dict[str, str]:
    """Expression of each column of the full-width panel, the same in both engines."""
    out = {}
    for i, c in enumerate(FULL.numeric):
        mixed = f"(l_orderkey * {37 * i + 11} + l_partkey * {i + 5} + l_linenumber)"
        out[c] = f"CASE WHEN {mixed} % {7 + i % 5} <> 0 THEN CAST({mixed} % {1009 + 2 * i} AS DOUBLE) / 8 END"
    return out


FULL_SQL = (
    "SELECT l_suppkey AS supplier, l_shipdate AS shipped, l_orderkey, l_linenumber, l_partkey, "
    + ", ".join(f"{e} AS {c}" for c, e in full_columns().items())
    + f", {FLAG} AS flag, {STATE} AS state FROM lineitem"
)
PANEL_SQL = {"user_id": EVENTS_SQL, "o_custkey": ORDERS_SQL, "l_suppkey": LINES_SQL, "supplier": FULL_SQL}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_panel(spark, f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", "event_type", F.expr(HOLES).alias("value")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderdate",
        "o_orderkey",
        "o_totalprice",
        F.expr(STATUS).alias("status"),
        F.expr(PRIORITY).alias("priority"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *[c for c in LINES.columns if c not in LINES.categorical],
        F.expr(FLAG).alias("flag"),
        F.expr(STATE).alias("state"),
    )


def full_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.selectExpr(
        "l_suppkey AS supplier",
        "l_shipdate AS shipped",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *[f"{e} AS {c}" for c, e in full_columns().items()],
        f"{FLAG} AS flag",
        f"{STATE} AS state",
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("value").alias("score"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("target"),
        F.expr(LOGIT).alias("probability"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") < 0).cast("int").alias("target")
    )


def rounded(df: DataFrame, digits: int = 6, skip: Iterable[str] = ()) -> DataFrame:
    """Sums are order-dependent in their last bits; results are compared rounded."""
    skip = set(skip)
    return df.selectExpr(
        *[
            f"round(CAST(`{f.name}` AS DOUBLE), {digits}) AS `{f.name}`"
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


def as_doubles(df: DataFrame, key: str, digits: int = 6) -> DataFrame:
    """Every feature as rounded double."""
    return df.selectExpr(
        key, *[f"round(CAST(`{c}` AS DOUBLE), {digits}) AS `{c}`" for c in df.columns if c != key]
    )


def numbered_sql(spec: PanelSpec) -> str:
    """A panel with position and row count per entity, as CTE body."""
    order = ", ".join(spec.order)
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {spec.entity} ORDER BY {order}) AS rn, "
        f"count(*) OVER (PARTITION BY {spec.entity}) AS n FROM ({PANEL_SQL[spec.entity]})"
    )


def per_entity_sql(spec: PanelSpec, columns: dict[str, str], digits: dict[str, int] | int = 6) -> str:
    """One aggregate row per entity; numeric results rounded."""
    parts = []
    for name, expr in columns.items():
        d = digits if isinstance(digits, int) else digits.get(name)
        parts.append(f'round(CAST({expr} AS DOUBLE), {d}) AS "{name}"' if d is not None else f'{expr} AS "{name}"')
    return f"SELECT {spec.entity}, {', '.join(parts)} FROM ({numbered_sql(spec)}) GROUP BY {spec.entity}"
