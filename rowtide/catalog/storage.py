"""Queries that go through files: labels, side tables, predictions, cached features."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.catalog import query
from rowtide.catalog.features import TREES
from rowtide.catalog.fixtures import ORDERS, as_doubles, labels, orders, table
from rowtide.catalog.sqlfeatures import feature_sql, filled_sql
from rowtide.operators import blocks
from rowtide.operators.positions import with_ordinals
from rowtide.plans.feature_row import attach, feature_row
from rowtide.session import new_path
from rowtide.sources.cache import cached_table
from rowtide.sources.tables import read_labels, read_predictions, read_side_features, write_predictions

_LAST = (
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate DESC, o_orderkey DESC) AS back FROM orders) WHERE back = 1"
)


@query(
    "csv_roundtrip",
    "SELECT o.o_custkey, o.o_totalprice AS prediction, CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS target, "
    f"c.c_acctbal AS balance, c.c_nationkey AS nation FROM ({_LAST}) o "
    "LEFT JOIN customer c ON c.c_custkey = o.o_custkey",
)
def csv_roundtrip(spark, sf_dir):
    label_file, side_file, out_file = (new_path(spark, n) for n in ("labels", "side", "predictions"))
    write_predictions(labels(spark, sf_dir), label_file)
    side = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"),
        F.lit(0).alias("target"),
    )
    write_predictions(side, side_file)

    numbered = with_ordinals(orders(spark, sf_dir), ORDERS)
    last = blocks.aggregate(numbered, "o_custkey", blocks.last_row(["o_totalprice"]))
    last = last.withColumnRenamed("o_totalprice", "prediction")
    side_back = read_side_features(spark, side_file, "o_custkey bigint, balance double, nation int, target int")
    joined = attach(last, side_back, "o_custkey", drop=("target",))
    joined = attach(joined, read_labels(spark, label_file, "o_custkey", entity_type="bigint"), "o_custkey")
    write_predictions(joined.select("o_custkey", "target", "prediction", "balance", "nation"), out_file)
    return read_predictions(
        spark, out_file, "o_custkey bigint, target int, prediction double, balance double, nation int"
    )


@query("feature_cache", filled_sql(feature_sql(ORDERS, TREES), "o_custkey"))
def feature_cache(spark, sf_dir):
    path = new_path(spark, "features")

    def build():
        return feature_row(orders(spark, sf_dir), ORDERS, TREES)

    cached_table(spark, path, build)
    return as_doubles(cached_table(spark, path, build), "o_custkey")
