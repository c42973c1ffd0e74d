"""Chunked scans against plain windows, with one key holding a third of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rowtide.operators.lookup import lookup
from rowtide.operators.ordered import CHUNK, OrderedGroups


def skewed(spark, rows=3000):
    return spark.range(rows, numPartitions=7).select(
        "id",
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(97)).alias("t"),
        F.when(F.col("id") % 11 == 0, F.col("id")).alias("v"),
    )


@pytest.mark.parametrize("keys", [["k"], []])
def test_scan_and_neighbours_equal_plain_windows(spark, conf, keys):
    conf("spark.rowtide.rowsPerChunk", 64)
    df = skewed(spark)
    groups = OrderedGroups(df, keys, ["t", "id"])
    assert groups.is_split
    got = groups.scan(
        running={"s": F.coalesce("v", F.lit(0))},
        sums={"all": F.col("id")},
        totals={"n": F.count("v")},
        row_number="rn",
    ).select("id", "s", "all", "n", "rn")
    w = Window.partitionBy(*keys).orderBy("t", "id")
    want = df.select(
        "id",
        F.sum(F.coalesce("v", F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.sum("id").over(Window.partitionBy(*keys)).alias("all"),
        F.count("v").over(Window.partitionBy(*keys)).alias("n"),
        F.row_number().over(w).cast("long").alias("rn"),
    )
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

    near = groups.neighbours(F.col("v"), "p", "f").select("id", "p", "f")
    plain = df.select(
        "id",
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("p"),
        F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("f"),
    )
    assert near.exceptAll(plain).isEmpty() and plain.exceptAll(near).isEmpty()


def test_chunks_are_balanced(spark, conf):
    conf("spark.rowtide.rowsPerChunk", 100)
    groups = OrderedGroups(skewed(spark, 30000), ["k"], ["t", "id"])
    sizes = groups.df.groupBy("k", CHUNK).count().agg(F.max("count")).first()[0]
    assert sizes < 400


def test_small_groups_stay_whole(spark):
    groups = OrderedGroups(skewed(spark), ["k"], ["t", "id"])
    assert not groups.is_split and CHUNK not in groups.df.columns


def test_chunk_count_is_bounded(spark, conf):
    conf("spark.rowtide.rowsPerChunk", 10)
    conf("spark.rowtide.maxChunks", 20)
    groups = OrderedGroups(skewed(spark), [], ["t", "id"])
    assert groups.df.select(CHUNK).distinct().count() <= 40


@pytest.mark.parametrize("broadcast_rows", [5, 100000])
def test_lookup_with_hot_and_missing_keys(spark, conf, broadcast_rows):
    conf("spark.rowtide.rowsPerChunk", 100)
    conf("spark.rowtide.broadcastRows", broadcast_rows)
    df = skewed(spark).withColumn("k", F.when(F.col("id") % 5 != 0, F.col("k")))
    table = df.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("uses"), F.sum("id").alias("total"))
    got = lookup(df, table, ["k"], uses="uses").select("id", "k", "total")
    want = df.join(table, "k", "left").select("id", "k", "total")
    assert got.count() == 3000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("broadcast", [{"Rows": 3}, {"Bytes": 40}, {}])
def test_lookup_matches_a_missing_key_with_a_missing_key(spark, conf, broadcast):
    for kind, most in broadcast.items():
        conf(f"spark.rowtide.broadcast{kind}", most)
    conf("spark.rowtide.rowsPerChunk", 100)
    df = skewed(spark).withColumn("k", F.when(F.col("id") % 3 != 0, F.col("k")))
    table = df.groupBy("k").agg(F.count("*").alias("uses"), F.sum("id").alias("total"))
    got = lookup(df, table, ["k"], uses="uses").select("id", "k", "total")
    want = df.alias("d").join(table.alias("t"), F.expr("d.k <=> t.k"), "left").select("id", "d.k", "total")
    assert got.filter("total IS NULL").isEmpty()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_splitting_adds_no_columns(spark, conf):
    df = skewed(spark)
    plain = OrderedGroups(df, ["k"], ["t", "id"]).scan(row_number="r", sums={"n": F.lit(1)})
    conf("spark.rowtide.rowsPerChunk", 20)
    groups = OrderedGroups(df, ["k"], ["t", "id"])
    cut = groups.scan(row_number="r", sums={"n": F.lit(1)})
    assert groups.is_split and cut.columns == plain.columns
    assert groups.neighbours(F.col("v"), "p", "f").columns == [*df.columns, "p", "f"]
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


def test_chunks_of_a_few_rows(spark, conf):
    conf("spark.rowtide.rowsPerChunk", 5)
    groups = OrderedGroups(skewed(spark), ["k"], ["t", "id"])
    assert groups.is_split
    assert groups.df.groupBy("k", CHUNK).count().agg(F.max("count")).first()[0] <= 12
