"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension (set where the value is positive), cut into
m segments of about log2(rows) - 2 bits. Rows with the same code are one entry of the
index, which is kept once per segment under that segment's value.

In round r each open query looks up all values that differ from its own in exactly r
bits, in every segment, and verifies full distances (those beyond its k-th so far are
passed over). A code within distance d of the
query has a segment within d / m bits, so after round r everything up to distance
m (r + 1) - 1 has been seen: a query is closed once its k-th verified distance is within
that. Each pair of codes is verified once, in the first round and segment that meet it.

Queries with the same code are one query. Results are ordered by distance, then id; a
query row is among its own results, as it is one of all rows.

Edge cases: a row with a null vector is no result and no query; null and NaN values give
a zero bit; missing trailing dimensions give zero bits; repeated ids are rows of their own;
with fewer than k rows all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import pick
from rowtide.session import materialise


_LONGEST = 30  # bits of a segment
_FULL = 2  # an index entry list holds some 2**_FULL codes: fewer lookups for a few more verified distances


def _code(dims: int, m: int, kind: str = "int"):
    """The code as an array of m segments, and the bits of a segment."""
    bits = -(-dims // m)
    start = F.lit(0).cast(kind)

    def segment(j: int):
        part = F.slice("embedding", j * bits + 1, bits)
        return F.aggregate(part, start, lambda acc, x: acc * 2 + F.when((x > 0) & ~F.isnan(x), 1).otherwise(0))

    return F.array(*[segment(j) for j in range(m)]), bits


def _differ(a: str, b: str, j: int) -> Column:
    return F.bit_count(F.col(a)[j].bitwiseXOR(F.col(b)[j]))


def search(vectors: DataFrame, is_query, k: int = 10, id_column: str = "vec_id") -> DataFrame:
    """query_id, rank, id, distance: the k nearest rows of each row for which ``is_query`` holds.

    ``is_query`` is a condition on the column ``id``.
    """
    rows = pick(vectors, id_column, "embedding").toDF("id", "embedding").filter(F.col("embedding").isNotNull())
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dims")).first()
    n, dims = shape["n"], max(1, shape["dims"] or 1)
    # A segment's value is an int.
    m = max(1, -(-dims // _LONGEST), round(dims / max(2.0, math.log2(max(n, 2)) - _FULL)))
    code, bits = _code(dims, m)
    m = -(-dims // bits)
    code, bits = _code(dims, m)
    full = F.concat("embedding", F.array_repeat(F.lit(0.0).cast("float"), F.lit(dims) - F.size("embedding")))
    words = _code(dims, -(-dims // 62), "long")[0]  # the same bits in as few numbers as hold them
    coded = rows.withColumn("embedding", full).select("id", F.struct(code.alias("parts"), words.alias("words")).alias("code"))
    coded = materialise(coded, "hamming-codes")
    # Of equal codes only the k least ids can be results.
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    entries = (
        coded.withColumn("place", place)
        .filter(F.col("place") <= k)
        .groupBy("code")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
    )
    entries = materialise(entries, "hamming-entries")
    index = entries.select("code", "ids", F.posexplode("code.parts").alias("segment", "value"))
    queries = coded.filter(is_query)
    open_ = queries.select(F.col("code").alias("query"), F.lit(None).cast("int").alias("bound")).distinct()
    open_ = materialise(open_, "hamming-queries")
    need = min(k, n)
    distance = reduce(Column.__add__, [_differ("query.words", "code.words", j) for j in range(-(-dims // 62))])
    held, closed = None, []
    for r in range(bits + 1):
        if open_.isEmpty():
            break
        masks = [sum(1 << b for b in chosen) for chosen in combinations(range(bits), r)]
        probes = open_.select("query", "bound", F.posexplode("query.parts").alias("segment", "own")).select(
            "query", "bound", "segment", F.explode(F.array(*map(F.lit, masks))).alias("mask"), "own"
        )
        probes = probes.select("query", "bound", "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("value"))
        # What is beyond the k-th so far is no result. The first segment at the least difference owns a pair.
        # Hinted, as the number of probes is known only once they are there: neither side is broadcast.
        wanted = F.col("bound").isNull() | (distance <= F.col("bound"))
        for j in range(m):
            wanted &= _differ("query.parts", "code.parts", j) >= F.lit(r) + (F.col("probe.segment") > j).cast("int")
        same = (F.col("probe.segment") == F.col("entry.segment")) & (F.col("probe.value") == F.col("entry.value"))
        met = probes.alias("probe").join(index.alias("entry").hint("merge"), same & wanted)
        found = met.select("query", "code", "ids", distance.alias("distance"))
        if held is not None:
            found = found.unionByName(held)
        order = Window.partitionBy("query").orderBy("distance", F.col("ids")[0])
        best = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")
        run = F.sum(F.size("ids")).over(order.rowsBetween(Window.unboundedPreceding, 0))
        kth = F.min(F.when(F.col("run") >= need, F.col("distance"))).over(Window.partitionBy("query"))
        judged = best.withColumn("run", run).withColumn("kth", kth)
        covered = F.coalesce(F.col("kth") <= m * (r + 1) - 1, F.lit(False)) if r < bits else F.lit(True)
        judged = materialise(judged.withColumn("done", covered).drop("run"), "hamming-round")
        closed.append(judged.filter("done").drop("done", "kth"))
        held = judged.filter("NOT done").drop("done", "kth")
        seen = judged.groupBy("query").agg(F.max("done").alias("done"), F.max("kth").alias("kth"))
        later = open_.join(seen.hint("merge"), "query", "left").filter("NOT coalesce(done, false)")
        open_ = materialise(later.select("query", F.col("kth").alias("bound")), "hamming-open")
    schema = "query_id bigint, rank int, id bigint, distance int"
    if not closed:
        return vectors.sparkSession.createDataFrame([], schema)
    result = closed[0]
    for part in closed[1:]:
        result = result.unionByName(part)
    each = result.select("query", "distance", F.explode("ids").alias("id"))
    order = Window.partitionBy("query").orderBy("distance", "id")
    top = each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    lists = materialise(
        top.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "distance"))).alias("hits")), "hamming-lists"
    )
    return (
        queries.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
        .join(lists, "query")
        .select("query_id", F.explode("hits").alias("h"))
        .select(F.col("query_id").cast("long").alias("query_id"), "h.rank", F.col("h.id").cast("long").alias("id"), "h.distance")
    )
