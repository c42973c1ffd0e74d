"""Physical plans: shuffles, pruning, no Python in the relational core."""

import re

from conftest import SMALL

from rowtide.catalog.features import RATIOS, TREES, WIDE
from rowtide.catalog.fixtures import LINES, ORDERS, events, labels, lines, orders
from rowtide.operators.ordered import OrderedGroups
from rowtide.operators.positions import pivot_positions
from rowtide.plans.feature_row import attach, feature_row


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"(?<!Broadcast)Exchange (\w+)", text)


def test_feature_row_shuffles_once(spark):
    text = plan(feature_row(lines(spark, SMALL), LINES, WIDE))
    assert exchanges(text) == ["hashpartitioning"]
    assert "Python" not in text and "ObjectHashAggregate" not in text and "Join" not in text
    assert text.count("HashAggregate(") == 2 and text.count("Sort [") == 1


def test_scan_reads_only_needed_columns(spark):
    df = lines(spark, SMALL).select("l_suppkey", "l_tax")
    text = plan(df.groupBy("l_suppkey").avg("l_tax"))
    assert "ReadSchema: struct<l_suppkey:bigint,l_tax:double>" in text
    narrow = feature_row(lines(spark, SMALL), LINES, RATIOS).select("l_suppkey", "l_tax")
    assert "l_extendedprice" not in plan(narrow).split("ReadSchema")[1]


def test_global_scan_has_no_single_partition_when_split(spark, conf):
    conf("spark.rowtide.rowsPerChunk", 100)
    df = events(spark, SMALL).select("event_id", "value")
    text = plan(OrderedGroups(df, [], ["event_id"]).scan(row_number="rn"))
    assert "SinglePartition" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_split_feature_row_has_no_python_and_no_cross_join(spark, conf):
    conf("spark.rowtide.rowsPerChunk", 60)
    text = plan(feature_row(lines(spark, SMALL), LINES, WIDE))
    assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text
    assert exchanges(text) == ["hashpartitioning", "hashpartitioning"]


def test_pivot_shuffles_once(spark):
    text = plan(pivot_positions(orders(spark, SMALL), ORDERS, ["o_totalprice"], 4))
    assert exchanges(text) == ["hashpartitioning"] and text.count("Sort [") == 1


def test_labels_join_without_moving_the_features_again(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    features = feature_row(orders(spark, SMALL), ORDERS, TREES)
    text = plan(attach(features, labels(spark, SMALL), "o_custkey"))
    assert exchanges(text) == ["hashpartitioning", "hashpartitioning"]  # panel, labels
