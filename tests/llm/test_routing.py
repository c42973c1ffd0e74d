"""Routes: leaders are the same whatever the order in which nodes arrive."""

from pyspark.sql import functions as F

from rowtide.llm import routing


def test_least_node_leads_a_key_of_many_chunks(spark):
    n = 2 * routing.PER_BUCKET + 200_000
    hot, other = F.unhex(F.lit("010203040506")), F.unhex(F.lit("0a0b0c0d0e0f"))
    routes = F.when(F.col("id") % 1000 == 0, F.concat(hot, other)).otherwise(hot)
    rows = spark.range(0, n, 1, 6).select((n - F.col("id")).alias("node"), routes.alias("routes"))
    for with_keys in (False, True):
        pairs = routing.led(rows, 16, with_keys)
        found = pairs.groupBy("leader").agg(F.count("*").alias("pairs"), F.count_distinct("node").alias("nodes")).collect()
        # 1 leads the hot key; 1000 is the least node on the other.
        extra = int(with_keys)
        assert {r["leader"]: r["nodes"] for r in found} == {1: n - 1 + extra, 1000: n // 1000 - 1 + extra}
        assert {r["leader"]: r["pairs"] for r in found} == {r["leader"]: r["nodes"] for r in found}
