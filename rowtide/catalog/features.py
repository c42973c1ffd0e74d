"""Queries for the feature blocks and the whole feature row."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.catalog import query
from rowtide.catalog.fixtures import (
    EVENTS,
    EVENTS_SQL,
    FULL,
    LINES,
    ORDERS,
    as_doubles,
    events,
    full_panel,
    labels,
    lines,
    orders,
    per_entity_sql,
    rounded,
    table,
)
from rowtide.catalog.sqlfeatures import MIDDLE, MIDDLE_ANY, at, div, feature_sql, filled_sql, first, last
from rowtide.operators import blocks, derive
from rowtide.operators.columns import fill_missing, narrow, require_parity, trim_statistics
from rowtide.operators.positions import with_ordinals
from rowtide.plans.feature_row import attach, feature_row, quantised
from rowtide.sources.chunks import backfill
from rowtide.sources.panel import read_panel, with_time
from rowtide.session import new_path
from rowtide.spec import FeatureOptions, PanelSpec

ALL = FeatureOptions()


def _per_entity(df, spec, *parts):
    return blocks.aggregate(df, spec.entity, *parts)


@query(
    "panel_stats",
    per_entity_sql(
        EVENTS,
        {
            "value_mean": "avg(value)",
            "value_min": "min(value)",
            "value_max": "max(value)",
            "value_std": "stddev_samp(value)",
            "value_sum": "coalesce(sum(value), 0)",
        },
    ),
)
def panel_stats(spark, sf_dir):
    df = events(spark, sf_dir)
    return rounded(_per_entity(df, EVENTS, blocks.statistics(["value"], ALL), blocks.sums(["value"])))


@query(
    "first_last_lag",
    per_entity_sql(
        EVENTS,
        {
            "value_first": first("value"),
            "value_last": last("value"),
            "value_last_lag_sub": f"{last('value')} - {first('value')}",
            "value_last_lag_div": div(last("value"), first("value")),
        },
    ),
)
def first_last_lag(spark, sf_dir):
    df = with_ordinals(events(spark, sf_dir), EVENTS)
    cols = ["value"]
    parts = (blocks.first_values(cols), blocks.last_values(cols), blocks.last_versus_first(cols))
    return rounded(_per_entity(df, EVENTS, *parts))


@query(
    "last_row",
    per_entity_sql(
        ORDERS,
        {c: at(c, "rn = n") for c in ("o_orderdate", "o_orderkey", "o_totalprice", "status", "priority")},
        {},
    ),
)
def last_row(spark, sf_dir):
    df = with_ordinals(orders(spark, sf_dir), ORDERS)
    cols = ["o_orderdate", "o_orderkey", "o_totalprice", "status", "priority"]
    return _per_entity(df, ORDERS, blocks.last_row(cols))


_NOW, _BACK1, _BACK2 = (at("value", f"rn = n - {p}") for p in (0, 1, 2))


@query(
    "diff_p",
    per_entity_sql(EVENTS, {"value_diff1": f"{_NOW} - {_BACK1}", "value_diff2": f"{_NOW} - {_BACK2}"}),
)
def diff_p(spark, sf_dir):
    df = with_ordinals(events(spark, sf_dir), EVENTS)
    return rounded(
        _per_entity(df, EVENTS, blocks.differences(["value"], 1), blocks.differences(["value"], 2))
    )


@query(
    "pct_change_p",
    per_entity_sql(
        EVENTS,
        {"value_pct_chg1": f"{div(_NOW, _BACK1)} - 1", "value_pct_chg2": f"{div(_NOW, _BACK2)} - 1"},
    ),
)
def pct_change_p(spark, sf_dir):
    df = with_ordinals(events(spark, sf_dir), EVENTS)
    return rounded(
        _per_entity(df, EVENTS, blocks.percent_changes(["value"], 1), blocks.percent_changes(["value"], 2))
    )


_MID = ("o_totalprice", "status", "priority")


@query(
    "middle_row",
    per_entity_sql(
        ORDERS,
        {f"{c}_mid": at(c, MIDDLE_ANY) for c in _MID}
        | {f"{c}_mid_gt2": at(c, f"n > 2 AND {MIDDLE}") for c in _MID},
        {},
    ),
)
def middle_row(spark, sf_dir):
    df = with_ordinals(orders(spark, sf_dir), ORDERS)
    return _per_entity(df, ORDERS, blocks.middle(_MID), blocks.middle_gt2(_MID))


_CATS = ("flag", "state")


@query(
    "cat_stats",
    per_entity_sql(
        LINES,
        {f"{c}_count": f"count({c})" for c in _CATS}
        | {f"{c}_nunique": f"count(DISTINCT {c})" for c in _CATS}
        | {f"{c}_std": f"stddev_samp({c})" for c in _CATS}
        | {f"{c}_first": first(c) for c in _CATS}
        | {f"{c}_mean": f"avg({c})" for c in _CATS},
        {f"{c}_{s}": 6 for c in _CATS for s in ("std", "mean")},
    ),
)
def cat_stats(spark, sf_dir):
    rows = lines(spark, sf_dir)
    codes = blocks.category_codes(rows, _CATS)
    stats = blocks.categories(_CATS, ALL, codes, dict(rows.dtypes))
    df = with_ordinals(rows, LINES)
    return rounded(_per_entity(df, LINES, stats, blocks.means(_CATS)))


@query(
    "calendar",
    per_entity_sql(
        ORDERS,
        {
            "o_orderdate_Count": "count(o_orderdate)",
            "o_orderdate_Sun_Count": "coalesce(nullif(count(*) FILTER (WHERE isodow(o_orderdate) = 7), 0), -1)",
            "o_orderdate_wk_std": "coalesce(stddev_samp(weekofyear(o_orderdate)), -1)",
        },
        {"o_orderdate_wk_std": 6},
    ),
)
def calendar(spark, sf_dir):
    text = orders(spark, sf_dir).withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    df = with_time(text, "o_orderdate")
    out = _per_entity(df, ORDERS, blocks.calendar_counts("o_orderdate"))
    return rounded(fill_missing(out, skip=["o_custkey"]))


def _mad_sql(c: str) -> str:
    return f"avg(abs({c} - m_{c}))"


@query(
    "mean_abs_dev",
    "SELECT l_suppkey, "
    + ", ".join(f"round({_mad_sql(c)}, 6) AS {c}_mad" for c in LINES.numeric)
    + " FROM (SELECT *, "
    + ", ".join(f"avg({c}) OVER (PARTITION BY l_suppkey) AS m_{c}" for c in LINES.numeric)
    + " FROM lineitem) GROUP BY l_suppkey",
)
def mean_abs_dev(spark, sf_dir):
    centres = {n: F.expr(e) for n, e in blocks.entity_means(LINES.numeric).items()}
    df = with_ordinals(lines(spark, sf_dir), LINES, **centres)
    return rounded(_per_entity(df, LINES, blocks.mean_abs_deviations(LINES.numeric)))


@query(
    "kurtosis_unbiased",
    per_entity_sql(LINES, {f"{c}_kurt": f"kurtosis({c})" for c in LINES.numeric}),
)
def kurtosis_unbiased(spark, sf_dir):
    return rounded(_per_entity(lines(spark, sf_dir), LINES, blocks.kurtoses(LINES.numeric)))


_FAMILY = ALL.with_(
    family_nets=(("P-S", "payment", "spend"), ("P-B", "payment", "balance")),
    after_pay=(("l_extendedprice", "l_discount"), ("l_quantity", "l_discount"), ("l_tax", "l_discount")),
)


@query(
    "row_family",
    per_entity_sql(
        LINES,
        {
            "P-S": at("l_discount - l_quantity", "rn = n"),
            "P-B": at("l_discount - l_extendedprice", "rn = n"),
            "l_extendedprice-l_discount": at("l_extendedprice - l_discount", "rn = n"),
            "l_quantity-l_discount": at("l_quantity - l_discount", "rn = n"),
            "l_tax-l_discount": at("l_tax - l_discount", "rn = n"),
        },
    ),
)
def row_family(spark, sf_dir):
    df = with_ordinals(lines(spark, sf_dir), LINES)
    last_ = _per_entity(df, LINES, blocks.last_row(LINES.numeric))
    derived = derive.family_nets(LINES, _FAMILY) | derive.after_pay(_FAMILY)
    return rounded(last_.selectExpr("l_suppkey", *[f"{e} AS `{n}`" for n, e in derived.items()]))


RATIOS = FeatureOptions(
    first=False,
    last_lag=False,
    calendar=False,
    category_stats=False,
    range_lag_families=("spend", "payment", "balance"),
    fixed_ratios=(("P2B9", "l_discount", "l_tax"),),
    zscore=True,
    pay_ratios=(("l_quantity", "l_discount", "l_tax"),),
    pay_sum_ratios=(("l_quantity", "l_discount", "l_tax"),),
    keep_sums=True,
)


@query("ratio_features", filled_sql(feature_sql(LINES, RATIOS), "l_suppkey"))
def ratio_features(spark, sf_dir):
    return as_doubles(feature_row(lines(spark, sf_dir), LINES, RATIOS), "l_suppkey")


@query(
    "quantise",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, "
    "round_even(l_extendedprice * (1 - l_discount) * 100, 0) / 100 AS net "
    "FROM lineitem",
)
def quantise_rows(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    rows = df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", net.alias("net"))
    return quantised(rows, PanelSpec("l_suppkey", LINES.order, ("net",)))


@query(
    "narrow",
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, CAST(l_partkey AS INT) AS part, "
    "l_orderkey * 1000000 AS big, "
    "CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS price FROM lineitem",
)
def narrow_rows(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_shipdate",
        F.col("l_partkey").alias("part"),
        (F.col("l_orderkey") * 1000000).alias("big"),
        F.col("l_extendedprice").alias("price"),
    )
    out = narrow(df, skip=["l_orderkey", "l_suppkey"])
    return out.withColumn("price", F.col("price").cast("double"))


TREES = FeatureOptions.for_trees(ORDERS, narrow=False, pct_changes=(1,))
NETWORK = FeatureOptions.for_networks(
    LINES,
    narrow=False,
    keep={
        "min": frozenset({"l_quantity", "l_extendedprice", "l_tax"}),
        "max": frozenset({"l_extendedprice", "l_discount", "l_tax"}),
        "std": frozenset({"l_quantity", "l_tax", "flag"}),
    },
    family_nets=_FAMILY.family_nets,
    after_pay=_FAMILY.after_pay,
    range_lag_families=RATIOS.range_lag_families,
    fixed_ratios=RATIOS.fixed_ratios,
    pay_ratios=RATIOS.pay_ratios,
    pay_sum_ratios=RATIOS.pay_sum_ratios,
)
WIDE = FeatureOptions.for_trees(
    LINES,
    narrow=False,
    diffs=(2, 3),
    pct_changes=(1, 2),
    family_nets=_FAMILY.family_nets,
    after_pay=_FAMILY.after_pay,
    range_lag_families=RATIOS.range_lag_families,
    fixed_ratios=RATIOS.fixed_ratios,
    zscore=True,
    pay_ratios=RATIOS.pay_ratios,
    pay_sum_ratios=RATIOS.pay_sum_ratios,
)

_LABELLED = (
    f"SELECT f.*, CASE WHEN c.c_acctbal < 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS target "
    f"FROM ({filled_sql(feature_sql(ORDERS, TREES), 'o_custkey')}) f "
    "LEFT JOIN customer c ON c.c_custkey = f.o_custkey"
)


@query("feature_row", _LABELLED)
def feature_row_orders(spark, sf_dir):
    features = feature_row(orders(spark, sf_dir), ORDERS, TREES)
    labelled = attach(features, labels(spark, sf_dir), "o_custkey")
    return as_doubles(labelled, "o_custkey")


@query(
    "narrow_feature_row",
    "SELECT o_custkey, round(CAST(CAST(coalesce(COLUMNS(* EXCLUDE (o_custkey)), -1) AS FLOAT) AS DOUBLE), 4) "
    f"FROM ({feature_sql(ORDERS, TREES)})",
)
def narrow_feature_row(spark, sf_dir):
    """The default preset: filled first, then narrowed where all values fit."""
    options = FeatureOptions.for_trees(ORDERS, pct_changes=(1,))
    return as_doubles(feature_row(orders(spark, sf_dir), ORDERS, options), "o_custkey", 4)


@query("feature_row_wide", filled_sql(feature_sql(LINES, WIDE), "l_suppkey"))
def feature_row_wide(spark, sf_dir):
    return as_doubles(feature_row(lines(spark, sf_dir), LINES, WIDE), "l_suppkey")


@query("feature_row_early", filled_sql(feature_sql(LINES, NETWORK), "l_suppkey"))
def feature_row_early(spark, sf_dir):
    return as_doubles(feature_row(lines(spark, sf_dir), LINES, NETWORK), "l_suppkey")


@query("chunked_backfill", filled_sql(feature_sql(ORDERS, TREES), "o_custkey"))
def chunked_backfill(spark, sf_dir):
    done = backfill(
        orders(spark, sf_dir), "o_custkey", lambda part: feature_row(part, ORDERS, TREES), chunks=4
    )
    return as_doubles(done, "o_custkey")


_KEEP = {
    "min": ("l_quantity", "l_tax"),
    "max": ("l_extendedprice",),
    "std": ("l_discount", "l_tax"),
}
_KEPT = [f"{c}_mean" for c in LINES.numeric] + [f"{c}_{s}" for s, cs in _KEEP.items() for c in cs]


def _stat_sql(name: str) -> str:
    c, s = name.rsplit("_", 1)
    return f"{ {'mean': 'avg', 'std': 'stddev_samp'}.get(s, s) }({c})"


@query("trim_columns", per_entity_sql(LINES, {n: _stat_sql(n) for n in _KEPT}))
def trim_columns(spark, sf_dir):
    full = _per_entity(lines(spark, sf_dir), LINES, blocks.statistics(LINES.numeric, ALL))
    return rounded(trim_statistics(full, _KEEP))


_SHARED = {
    "mean": ("l_quantity", "l_discount", "l_tax"),
    "min": ("l_quantity", "l_extendedprice"),
    "max": ("l_extendedprice", "l_tax"),
    "std": ("l_quantity", "l_discount"),
}


def _keyed_stats_sql(source: str, key: str) -> str:
    names = [f"{c}_{s}" for s, cs in _SHARED.items() for c in cs]
    stats = ", ".join(f"round({_stat_sql(n)}, 9) AS {n}" for n in names)
    return f"SELECT '{source}' AS source, {key} AS entity, {stats} FROM lineitem GROUP BY {key}"


@query(
    "schema_parity",
    _keyed_stats_sql("supplier", "l_suppkey") + " UNION ALL " + _keyed_stats_sql("part", "l_partkey"),
)
def schema_parity(spark, sf_dir):
    kept = ALL.with_(keep={s: frozenset(c) for s, c in _SHARED.items()})
    stats = blocks.statistics(LINES.numeric, kept)

    def table_for(key):
        df = lines(spark, sf_dir).withColumn("entity", F.col(key))
        return blocks.aggregate(df, "entity", stats)

    left, right = table_for("l_suppkey"), table_for("l_partkey")
    require_parity(left, right)
    both = left.select(F.lit("supplier").alias("source"), "*").unionByName(
        right.select(F.lit("part").alias("source"), "*")
    )
    return rounded(both, 9)


@query(
    "impute",
    "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN -1 ELSE value END AS value, "
    "CASE WHEN event_id % 7 = 0 OR value = 1 THEN -1 ELSE round(1 / ln(value), 6) END AS inverse FROM events",
)
def impute(spark, sf_dir):
    df = events(spark, sf_dir)
    inverse = F.when(F.col("value") == 1, F.lit(float("inf"))).otherwise(
        F.try_divide(F.lit(1.0), F.log("value"))
    )
    filled = fill_missing(df.select("event_id", "value", inverse.alias("inverse")), skip=["event_id"])
    return filled.withColumn("inverse", F.round("inverse", 6))


_SCANNED = ["l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_tax"]


@query("panel_scan", f"SELECT {', '.join(_SCANNED)} FROM lineitem")
def panel_scan(spark, sf_dir):
    """A drop list, numeric columns by exclusion, and only what the description names; types as stored."""
    path = f"{sf_dir}/lineitem.parquet"
    dropped = ["l_discount", "l_linestatus"]
    columns = [c for c in spark.read.parquet(path).columns if c not in dropped]
    spec = PanelSpec.from_columns(columns, LINES.entity, LINES.order, categorical=["l_returnflag"])
    return read_panel(spark, path, spec, drop=dropped).drop("l_returnflag")


FULL_TREES = FeatureOptions.for_trees(FULL, narrow=False, quantise=False, diff1=FULL.numeric[:20], middle=FULL.numeric[:20])


@query("feature_row_full", filled_sql(feature_sql(FULL, FULL_TREES), "supplier"))
def feature_row_full(spark, sf_dir):
    """The feature row at full width: 190 numeric columns, some 2,200 outputs."""
    return as_doubles(feature_row(full_panel(spark, sf_dir), FULL, FULL_TREES), "supplier")


@query(
    "panel_head",
    f"SELECT user_id, ts, event_id, value FROM ({EVENTS_SQL}) ORDER BY user_id, ts, event_id LIMIT 200",
)
def panel_head(spark, sf_dir):
    """The first rows of the panel in its order."""
    head = PanelSpec("user_id", ("ts", "event_id"), ("value",))
    rows = read_panel(spark, f"{sf_dir}/events.parquet", head, rows=200)
    return rows.withColumn("value", F.expr("CASE WHEN event_id % 7 <> 0 THEN value END")).select("user_id", "ts", "event_id", "value")


_HALF = "o_custkey % 2 = {}"


@query(
    "narrow_stored",
    "SELECT o_custkey, round(CAST(CAST(coalesce(COLUMNS(* EXCLUDE (o_custkey)), -1) AS FLOAT) AS DOUBLE), 4) "
    f"FROM ({feature_sql(ORDERS, TREES)}) WHERE {_HALF.format(1)}",
)
def narrow_stored(spark, sf_dir):
    """Rows of unseen customers, with the types that the other half has decided."""
    options = FeatureOptions.for_trees(ORDERS, pct_changes=(1,))
    rows, path = orders(spark, sf_dir), new_path(spark, "types")
    first = feature_row(rows.filter(_HALF.format(0)), ORDERS, options, path)
    second = feature_row(rows.filter(_HALF.format(1)), ORDERS, options, path)
    require_parity(first, second)
    return as_doubles(second, "o_custkey", 4)
