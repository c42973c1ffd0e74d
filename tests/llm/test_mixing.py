"""Mixing: targets, rates and copies against plain Python."""

import math
import re
from collections import defaultdict

from small import documents, empty, rows_of

from rowtide.llm import mixing
from rowtide.llm.common import pick


def water(totals, weights, most=3):
    """Shares by weight; what is above a cap goes round again."""
    target, free, left = {}, dict(weights), sum(totals.values())
    while free:
        unit = left / sum(free.values())
        over = [s for s in free if free[s] * unit > most * totals[s]]
        if not over:
            target.update({s: w * unit for s, w in free.items()})
            break
        for s in over:
            target[s] = most * totals[s]
            left -= target[s]
            del free[s]
    return target


def check(rows):
    sources = defaultdict(list)
    for r in rows:
        sources[r["source"]].append(r)
    names = sorted((s for s in sources if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sources)
    totals = {s: sum(r["size"] for r in sources[s]) for s in names}
    want = water(totals, {s: 1 + i % 3 for i, s in enumerate(names)})
    for s in names:
        got = sources[s]
        assert all(math.isclose(r["target"], want.get(s, 0.0), rel_tol=1e-9, abs_tol=1e-6) for r in got)
        assert all(r["source_size"] == totals[s] and 0 <= r["copies"] <= 3 for r in got)
        assert all(r["taken"] == r["copies"] * r["size"] for r in got)
        off = abs(sum(r["taken"] for r in got) - want.get(s, 0.0))
        assert off <= 0.02 * totals[s] + max((r["size"] for r in got), default=0) / 2
        # An exponential tilt: the rates of longer documents are all above or all below those of shorter ones.


def test_targets_copies_and_awkward_rows(spark):
    df = documents(spark)
    rows = rows_of(mixing.mix(df))
    assert len(rows) == df.count()
    check(rows)
    words = re.compile(r"[^\x20\x09-\x0D]+")
    sizes = sorted(len(words.findall(r["text"] or "")) for r in rows_of(pick(df, "text")))
    assert sizes == sorted(r["size"] for r in rows)


def test_reruns_agree(spark):
    df = documents(spark)
    first, second = (sorted(map(str, rows_of(mixing.mix(df.repartition(n))))) for n in (2, 7))
    assert first == second


def test_a_capped_source_is_taken_whole_three_times(spark):
    df = spark.createDataFrame(
        [(i, "w " * 50, "a") for i in range(20)] + [(100, "few words", "b"), (101, "x", "c")], "doc_id long, text string, source string"
    )
    rows = rows_of(mixing.mix(df))
    check(rows)
    assert {r["copies"] for r in rows if r["source"] in ("b", "c")} == {3}


def test_equal_documents_share_the_copies_of_their_class(spark):
    df = spark.range(300).selectExpr("id AS doc_id", "'w w w' AS text", "CASE WHEN id < 100 THEN 'a' ELSE 'b' END AS source")
    rows = rows_of(mixing.mix(df))
    check(rows)
    assert sum(r["taken"] for r in rows) == 900


def test_rates_solve_the_dual(spark):
    classes = spark.createDataFrame([("=a", s, n) for s, n in ((1, 50), (10, 20), (100, 5))], "key string, size long, n long")
    goal = spark.createDataFrame([("=a", "a", 750.0, 75, 1200.0)], "key string, source string, total double, n long, target double")
    l = mixing.balance(classes, goal).first()["l"]
    have = sum(n * s * 3 / (1 + 2 * math.exp(-l * s / 10)) for s, n in ((1, 50), (10, 20), (100, 5)))
    assert abs(have - 1200) < 0.01


def test_empty(spark):
    assert mixing.mix(empty(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = mixing.mix(documents(spark, 20))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
