"""Queries for the ranking metric, losses, folds and samples."""

from __future__ import annotations

from rowtide.catalog import query
from rowtide.catalog.fixtures import SCORED_SQL, rounded, scored
from rowtide.operators.folds import fixed_sample, stratified_folds
from rowtide.operators.metric import losses, mean_score, metric_components, top_share

_FOLDED = (
    "SELECT *, CAST((row_number() OVER (PARTITION BY target ORDER BY md5('42:' || event_id), event_id) - 1) "
    f"% 5 AS INT) AS fold FROM ({SCORED_SQL})"
)


def _weights_sql(source: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return (
        "SELECT *, sum(weight) OVER o AS cum_weight, sum(target) OVER o AS cum_pos, "
        "sum(weight) OVER g AS total_weight, sum(target) OVER g AS n_pos, "
        "sum(1 - target) OVER g AS n_neg FROM "
        f"(SELECT *, CASE target WHEN 0 THEN 20 ELSE 1 END AS weight FROM ({source})) "
        f"WINDOW o AS ({part} ORDER BY score DESC NULLS LAST, event_id ROWS UNBOUNDED PRECEDING), g AS ({part})"
    )


def _components_sql(source: str, by: str = "") -> str:
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return (
        f"SELECT {keys}n_pos, n_neg, round(gini_raw, 4) AS gini_raw, round(gini_perfect, 4) AS gini_perfect, "
        "round(gini_raw / gini_perfect, 9) AS gini, round(captured / n_pos, 9) AS top_capture, "
        "round(0.5::DOUBLE * (gini_raw / gini_perfect + captured / n_pos), 9) AS score FROM ("
        f"SELECT {keys}CAST(max(n_pos) AS BIGINT) AS n_pos, CAST(max(n_neg) AS BIGINT) AS n_neg, "
        "sum((cum_pos::DOUBLE / n_pos::DOUBLE - cum_weight::DOUBLE / total_weight::DOUBLE) * weight) AS gini_raw, "
        "10 * max(n_neg)::DOUBLE * (max(n_pos) + 20 * max(n_neg) - 19)::DOUBLE / (max(n_pos) + 20 * max(n_neg))"
        "::DOUBLE AS gini_perfect, "
        "CAST(count(*) FILTER (WHERE target = 1 AND cum_weight <= floor(0.04::DOUBLE * total_weight::DOUBLE)) "
        f"AS DOUBLE) AS captured FROM ({_weights_sql(source, by)}) {group})"
    )


def _rounded_components(df):
    money = rounded(df, 4, skip=["gini", "top_capture", "score"])
    return rounded(money, 9, skip=["gini_raw", "gini_perfect"])


@query("metric_components", _components_sql(SCORED_SQL))
def metric(spark, sf_dir):
    return _rounded_components(metric_components(scored(spark, sf_dir), "target", "score", "event_id"))


_HOLES_SQL = (
    "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE score END AS score, "
    f"CASE WHEN event_id % 11 = 0 THEN NULL ELSE target END AS target FROM ({SCORED_SQL})"
)


@query("metric_missing", _components_sql(f"SELECT * FROM ({_HOLES_SQL}) WHERE target IS NOT NULL"))
def metric_missing(spark, sf_dir):
    """Rows without a score (NULL or NaN) come last; rows without a label take no part."""
    df = scored(spark, sf_dir).selectExpr(
        "event_id",
        "CASE WHEN event_id % 14 = 0 THEN double('NaN') WHEN event_id % 7 != 0 THEN score END AS score",
        "CASE WHEN event_id % 11 != 0 THEN target END AS target",
    )
    return _rounded_components(metric_components(df, "target", "score", "event_id"))


@query("metric_by_fold", _components_sql(_FOLDED, "fold"))
def metric_by_fold(spark, sf_dir):
    folded = stratified_folds(scored(spark, sf_dir), "event_id", "target")
    return _rounded_components(metric_components(folded, "target", "score", "event_id", ["fold"], derived=True))


@query(
    "mean_fold_score",
    f"SELECT round(avg(score), 8) AS mean_score, count(score) AS folds FROM ({_components_sql(_FOLDED, 'fold')})",
)
def mean_fold_score(spark, sf_dir):
    folded = stratified_folds(scored(spark, sf_dir), "event_id", "target")
    by_fold = metric_components(folded, "target", "score", "event_id", ["fold"], derived=True)
    return rounded(mean_score(by_fold), 8)


@query(
    "top_share",
    "SELECT event_id, score, CAST(target AS BIGINT) AS target, CAST(weight AS BIGINT) AS weight, "
    f"CAST(cum_weight AS BIGINT) AS cum_weight FROM ({_weights_sql(SCORED_SQL)}) "
    "WHERE cum_weight <= floor(0.04::DOUBLE * total_weight::DOUBLE)",
)
def top_share_rows(spark, sf_dir):
    return top_share(scored(spark, sf_dir), "target", "score", "event_id")


_BCE = "-(target * ln(p) + (1 - target) * ln(1 - p))"


@query(
    "loss_report",
    f"SELECT round(avg({_BCE}), 9) AS bce, "
    f"round(avg(0.8::DOUBLE * pow(1 - exp(-({_BCE})), 2) * ({_BCE})), 9) AS focal, "
    f"round(avg({_BCE}) + 1 - (2 * sum(target * probability) + 1e-6) "
    "/ (sum(target) + sum(probability) + 1e-6), 9) AS dice_bce "
    "FROM (SELECT *, least(greatest(probability, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE) AS p "
    f"FROM ({SCORED_SQL}))",
)
def loss_report(spark, sf_dir):
    return rounded(losses(scored(spark, sf_dir), "target", "probability"), 9)


@query("stratified_folds", f"SELECT event_id, target, fold FROM ({_FOLDED})")
def folds(spark, sf_dir):
    return stratified_folds(scored(spark, sf_dir).select("event_id", "target"), "event_id", "target")


@query(
    "fixed_sample",
    f"SELECT event_id, target, score FROM ({SCORED_SQL}) ORDER BY md5('42:' || event_id), event_id LIMIT 2000",
)
def sample(spark, sf_dir):
    return fixed_sample(scored(spark, sf_dir).select("event_id", "target", "score"), "event_id")
