"""Search over binary codes against all distances."""

import random

import pytest
from pyspark.sql import functions as F
from small import rows_of

from rowtide.llm import hamming

SCHEMA = "vec_id long, embedding array<float>, rank string, code string"


def brute(rows, k, is_query):
    dims = max((len(v) for _, v in rows if v is not None), default=1)
    code = lambda v: [int(x is not None and x == x and x > 0) for x in v] + [0] * (dims - len(v))
    coded = [(i, code(v)) for i, v in rows if v is not None]
    out = []
    for q, a in coded:
        if q is not None and is_query(q):
            near = sorted((sum(x != y for x, y in zip(a, b, strict=True)), i) for i, b in coded if i is not None)[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return sorted(out)


def search(spark, rows, k, every):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(3)
    got = rows_of(hamming.search(df, F.col("id") % every == 0, k))
    return sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in got)


@pytest.mark.parametrize(("n", "dims", "k", "every"), [(400, 16, 10, 7), (150, 64, 5, 10), (30, 9, 10, 3), (6, 70, 10, 2), (1, 4, 3, 1)])
def test_exact(spark, n, dims, k, every):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dims)]) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(n // 3)]  # one code that a third of the rows have
    rows += [(rows[0][0], rows[0][1])] * 2
    assert search(spark, rows, k, every) == brute(rows, k, lambda q: q % every == 0)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, -1.0, 1.0, 1.0]), (1, None), (2, [float("nan"), 1.0, None, 1.0]), (3, [1.0]), (4, []), (0, [-1.0] * 4)]
    assert search(spark, rows, 3, 2) == brute(rows, 3, lambda q: q % 2 == 0)


def test_empty(spark):
    assert search(spark, [], 3, 1) == [] and search(spark, [(1, None)], 3, 1) == []


def test_segments_of_a_large_table_stay_within_an_int(spark):
    """Two segments of 64 bits would be 32 bits each."""
    ones = spark.createDataFrame([(0, [1.0] * 64)], "id int, embedding array<float>")
    m = -(-64 // hamming._LONGEST)
    code, bits = hamming._code(64, m)
    assert bits <= 30 and ones.select(code.alias("c")).first()["c"] == [2**22 - 1, 2**22 - 1, 2**20 - 1]
