"""Queries for ranks, segments, positions and standardising."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.catalog import query
from rowtide.catalog.fixtures import EVENTS_SQL, ORDERS, ORDERS_SQL, events, orders, rounded
from rowtide.operators.columns import drop_matching
from rowtide.operators.positions import pivot_positions, with_time_ranks
from rowtide.operators.ranks import global_rank, rank_by_category, standardise_by_category
from rowtide.operators.segments import factorize, with_segments

_TIES = "(count(*) OVER (PARTITION BY {by}value) - 1) / 2.0"


@query(
    "rank_by_cat",
    "SELECT event_id, event_type, value, CASE WHEN value IS NULL THEN NULL ELSE round(("
    "rank() OVER (PARTITION BY event_type ORDER BY value NULLS LAST) + "
    + _TIES.format(by="event_type, ")
    + ") / count(value) OVER (PARTITION BY event_type), 9) END AS value_pct_rank_by_event_type "
    f"FROM ({EVENTS_SQL})",
)
def rank_by_cat(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", "event_type", "value")
    return rounded(rank_by_category(df, ["value"], ["event_type"], ["event_id"]), 9)


@query(
    "global_rank",
    "SELECT event_id, value, CASE WHEN value IS NULL THEN NULL ELSE round(("
    "rank() OVER (ORDER BY value NULLS LAST) + "
    + _TIES.format(by="")
    + f") / count(*) OVER (), 9) END AS value_global_rank FROM ({EVENTS_SQL})",
)
def global_rank_rows(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", "value")
    return rounded(global_rank(df, ["value"], ["event_id"]), 9)


@query(
    "standardise_by_cat",
    "SELECT event_id, event_type, round((value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0), 6) "
    f"AS value_standardized_by_event_type FROM ({EVENTS_SQL}) WINDOW w AS (PARTITION BY event_type)",
)
def standardise_by_cat(spark, sf_dir):
    df = events(spark, sf_dir).select("event_id", "event_type", "value")
    out = standardise_by_category(df, ["value"], ["event_type"], ["event_id"])
    return rounded(out.drop("value"))


_SEEN = (
    "SELECT o_custkey, rows_, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS cid, "
    "CAST(sum(rows_) OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS cus_count FROM ("
    "SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn, "
    "count(*) OVER (PARTITION BY o_custkey) AS rows_ FROM orders) WHERE rn = 1"
)


@query("factorize", f"SELECT o_custkey, cid, rows_ AS n_rows FROM ({_SEEN})")
def factorize_customers(spark, sf_dir):
    codes = factorize(orders(spark, sf_dir), "o_custkey", ["o_orderdate", "o_orderkey"])
    return codes.withColumnRenamed("__rows", "n_rows")


@query(
    "segments",
    f"SELECT o.o_orderkey, o.o_custkey, s.cid, s.cus_count FROM orders o JOIN ({_SEEN}) s USING (o_custkey)",
)
def segments(spark, sf_dir):
    df = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate")
    return with_segments(df, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


_POSITIONED = (
    "SELECT *, max(o_orderdate) OVER k AS max_time, count(*) OVER k AS size, "
    "rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) "
    "+ (count(*) OVER (PARTITION BY o_custkey, o_orderdate) - 1) / 2.0 AS time_rank, "
    "row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) - 1 AS cumcount "
    f"FROM ({ORDERS_SQL}) WINDOW k AS (PARTITION BY o_custkey)"
)


@query(
    "reverse_position",
    "SELECT o_orderkey, o_custkey, max_time, size, CAST(time_rank AS DOUBLE) AS time_rank, "
    f"CAST(trunc(size - time_rank) AS INT) AS statement, cumcount FROM ({_POSITIONED})",
)
def reverse_position(spark, sf_dir):
    ranked = with_time_ranks(orders(spark, sf_dir), ORDERS)
    return ranked.select(
        "o_orderkey", "o_custkey", "max_time", "size", "time_rank", "statement", "cumcount"
    )


_PIVOTED = ["o_totalprice", "status"]


def _pivot_sql(columns, where: str = "TRUE") -> str:
    """The pivot by row: a name for each position that the data holds."""
    parts = [
        f"SELECT o_custkey, '{c}__TE' || CAST(trunc(size - time_rank) AS INT) AS name, "
        f"CAST(arg_max({c}, cumcount) AS DOUBLE) AS value FROM ({_POSITIONED}) "
        f"WHERE {where} GROUP BY o_custkey, trunc(size - time_rank)"
        for c in columns
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE value IS NOT NULL"


def _by_row(wide):
    """Columns come from the data, so they are compared by name and row."""
    columns = wide.columns[1:]
    doubles = wide.select("o_custkey", *[wide[f"`{c}`"].cast("double").alias(c) for c in columns])
    return doubles.unpivot("o_custkey", columns, "name", "value").filter("value IS NOT NULL")


@query("pivot_positions", _pivot_sql(_PIVOTED))
def pivot(spark, sf_dir):
    return _by_row(pivot_positions(orders(spark, sf_dir), ORDERS, _PIVOTED))


@query("drop_old_positions", _pivot_sql(["status"], "trunc(size - time_rank) NOT BETWEEN 7 AND 11"))
def drop_old_positions(spark, sf_dir):
    wide = pivot_positions(orders(spark, sf_dir), ORDERS, ["status"])
    return _by_row(drop_matching(wide, [r"_TE7$", r"_TE8$", r"_TE9$", r"_TE10$", r"_TE11$"], skip=["o_custkey"]))


_UNNAMED = "SELECT * REPLACE (CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END AS o_custkey) FROM orders"


@query(
    "segments_null_entity",
    f"SELECT o.o_orderkey, o.o_custkey, s.cid, s.cus_count FROM ({_UNNAMED}) o "
    f"JOIN ({_SEEN.replace('FROM orders', f'FROM ({_UNNAMED})')}) s ON s.o_custkey IS NOT DISTINCT FROM o.o_custkey",
)
def segments_null_entity(spark, sf_dir):
    """Rows without an entity are one segment, whichever way they are joined."""
    df = orders(spark, sf_dir).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderdate"
    )
    return with_segments(df, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


_SHIFTED = "SELECT event_id, event_type, value, value * 2 - event_id % 50 AS other, CAST(event_id % 4 AS INT) AS part FROM ({})"
_MANY = [(f, c) for c in ("event_type", "part") for f in ("value", "other")]


@query(
    "rank_by_cat_many",
    "SELECT event_id, "
    + ", ".join(
        f"CASE WHEN {f} IS NULL THEN NULL ELSE round((rank() OVER (PARTITION BY {c} ORDER BY {f} NULLS LAST) "
        f"+ (count(*) OVER (PARTITION BY {c}, {f}) - 1) / 2.0) / count({f}) OVER (PARTITION BY {c}), 9) END "
        f"AS {f}_pct_rank_by_{c}"
        for f, c in _MANY
    )
    + f" FROM ({_SHIFTED.format(EVENTS_SQL)})",
)
def rank_by_cat_many(spark, sf_dir):
    df = events(spark, sf_dir).selectExpr(
        "event_id", "event_type", "value", "value * 2 - event_id % 50 AS other", "CAST(event_id % 4 AS INT) AS part"
    )
    ranked = rank_by_category(df, ["value", "other"], ["event_type", "part"], ["event_id"])
    return rounded(ranked.drop("event_type", "value", "other", "part"), 9)
