"""Transformers, target encoding, importance, wide aggregates and growing feature tables."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from rowtide.catalog.fixtures import FULL, ORDERS, full_panel, orders
from rowtide.catalog.models import tree_run
from rowtide.catalog.transformers import GROWING
from rowtide.operators import blocks, quantile
from rowtide.operators.polynomial import exponent_table, feature_name, polynomial, sparse_pairs
from rowtide.operators import power
from rowtide.operators.power import fit_power, power_transform, yeo_johnson
from rowtide.operators.quantile import fit_quantiles, quantile_transform
from rowtide.operators.target_encode import encode_target, fit_target_encoding
from rowtide.plans import importance
from rowtide.plans.feature_row import feature_row
from rowtide.plans.increment import FeatureTable
from rowtide.plans.models import node_table
from rowtide.session import materialise


def numbers(spark, columns):
    names = list(columns)
    rows = [(i, *v) for i, v in enumerate(zip(*columns.values(), strict=True))]
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"`{n}` double" for n in names)).repartition(4)


def awkward(n=3000):
    rng = random.Random(4)
    return {
        "even": [rng.random() for _ in range(n)],
        "tied": [float(rng.choice([1, 1, 1, 2, 5])) for _ in range(n)],
        "one value": [3.0] * n,
        "gaps": [rng.choice([None, float("nan"), float("inf"), rng.gauss(0, 1)]) for _ in range(n)],
        "empty": [None] * n,
    }


def usable(values):
    return [v for v in values if v is not None and math.isfinite(v)]


@pytest.mark.parametrize("steps", [2, 5, 201])
def test_quantiles_are_exact(spark, steps):
    data = awkward()
    fitted = fit_quantiles(numbers(spark, data), list(data), steps).collect()
    for c, values in data.items():
        mine = sorted((r.step, r.reference, r.value) for r in fitted if r.feature == c)
        if not usable(values):
            assert not mine
            continue
        references = np.linspace(0, 1, steps)
        assert [s for s, _, _ in mine] == list(range(steps))
        assert [r for _, r, _ in mine] == pytest.approx(references.tolist())
        assert [v for _, _, v in mine] == pytest.approx(np.quantile(usable(values), references).tolist(), rel=1e-12)


def test_quantiles_do_not_hang_on_the_summary(spark, monkeypatch, conf):
    data = awkward(1500)
    df = numbers(spark, data)
    fine = sorted(map(tuple, fit_quantiles(df, list(data), 21).collect()))
    monkeypatch.setattr(quantile, "ACCURACY", 6)  # cut points that are far off
    assert sorted(map(tuple, fit_quantiles(df, list(data), 21).collect())) == fine


def test_places_between_quantiles(spark):
    data = awkward(800)
    df = numbers(spark, data)
    fitted = materialise(fit_quantiles(df, list(data), 11), "fitted")
    shares = {r.id: r for r in quantile_transform(df, fitted, list(data)).collect()}
    scores = {r.id: r for r in quantile_transform(df, fitted, list(data), "normal").collect()}
    references = np.linspace(0, 1, 11)
    for c, values in data.items():
        q = np.quantile(usable(values), references) if usable(values) else None
        for i, v in enumerate(values):
            if v is None or not math.isfinite(v):
                assert shares[i][c] is None and scores[i][c] is None
                continue
            up = np.interp(v, q, references)
            down = 1 - np.interp(-v, -q[::-1], references)
            want = 0.0 if v <= q[0] else 1.0 if v >= q[-1] else (up + down) / 2
            if c == "tied":  # repeated quantiles: the middle of the references of equal ones
                same = references[q == v]
                want = want if v <= q[0] or v >= q[-1] or not len(same) else (same[0] + same[-1]) / 2
            assert shares[i][c] == pytest.approx(want, abs=1e-12)
            held = min(max(want, 1e-7), 1 - 1e-7)
            assert 0.5 * (1 + math.erf(scores[i][c] / math.sqrt(2))) == pytest.approx(held, abs=1e-9)
    beyond = spark.createDataFrame([(0, -5.0), (1, 5.0)], "id int, even double")
    assert [r.even for r in quantile_transform(beyond, fitted, ["even"]).orderBy("id").collect()] == [0.0, 1.0]
    with pytest.raises(ValueError, match="output"):
        quantile_transform(df, fitted, ["even"], "log")
    with pytest.raises(ValueError, match="two quantiles"):
        fit_quantiles(df, ["even"], 1)


def transformed(x, p):
    if x >= 0:
        return math.log1p(x) if abs(p) < 1e-12 else (math.exp(p * math.log1p(x)) - 1) / p
    return -math.log1p(-x) if abs(2 - p) < 1e-12 else -(math.exp((2 - p) * math.log1p(-x)) - 1) / (2 - p)


def test_power_and_its_derivatives(spark):
    points = [(x, p) for x in (-30.0, -1.5, -1e-4, 0.0, 1e-5, 0.7, 250.0) for p in (-2.0, -1e-3, 0.0, 1e-3, 0.5, 1.0, 2.0 - 1e-4, 2.0, 3.0)]
    rows = spark.createDataFrame(points, "x double, p double").selectExpr("x", "p", *[f"{e} AS y{i}" for i, e in enumerate(yeo_johnson("x", "p"))])
    h = 1e-4
    for r in rows.collect():
        y = lambda p, x=r.x: transformed(x, p)
        assert r.y0 == pytest.approx(y(r.p), rel=1e-9, abs=1e-12)
        scale = abs(r.y1) + abs(r.y2) + 1e-6
        if min(abs(r.p), abs(2 - r.p)) > 1e-2:
            assert r.y1 == pytest.approx((y(r.p + h) - y(r.p - h)) / (2 * h), abs=1e-5 * scale)
            assert r.y2 == pytest.approx((y(r.p + h) - 2 * y(r.p) + y(r.p - h)) / h**2, abs=1e-3 * scale + 1e-6)


def likelihood(values, p):
    y = np.array([transformed(v, p) for v in values])
    return -len(y) / 2 * math.log(y.var()) + (p - 1) * sum(math.copysign(math.log1p(abs(v)), v) for v in values)


def test_powers_are_the_most_likely_ones(spark):
    rng = random.Random(6)
    data = {
        "lognormal": [math.exp(rng.gauss(1, 0.8)) for _ in range(1500)],
        "left": [-math.exp(rng.gauss(0, 0.5)) for _ in range(1500)],
        "normal": [rng.gauss(0, 2) for _ in range(1500)],
        "gaps": [rng.choice([None, float("nan"), float("inf"), rng.random() ** 3]) for _ in range(1500)],
        "constant": [2.0] * 1500,
        "empty": [None] * 1500,
    }
    df = numbers(spark, data)
    fitted = fit_power(df, list(data))
    powers = {r.feature: r.power for r in fitted.collect()}
    assert powers["constant"] == 1.0 and powers["empty"] == 1.0
    for c in ("lognormal", "left", "normal", "gaps"):
        best = likelihood(usable(data[c]), powers[c])
        for off in (-0.02, -1e-3, 1e-3, 0.02):
            assert best > likelihood(usable(data[c]), powers[c] + off)
    out = power_transform(df, fitted, list(data)).agg(*[f(c).alias(f"{n}_{c}") for c in ("lognormal", "left", "gaps") for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    for c in ("lognormal", "left", "gaps"):
        assert abs(out[f"m_{c}"]) < 1e-9 and out[f"s_{c}"] == pytest.approx(1, abs=1e-9)
    raw = {r.id: r.lognormal for r in power_transform(df, fitted, ["lognormal"], standardise=False).collect()}
    assert raw[7] == pytest.approx(transformed(data["lognormal"][7], powers["lognormal"]), rel=1e-9)


def test_few_steps_go_over_all_rows(spark, monkeypatch):
    rng = random.Random(8)
    data = {"lognormal": [math.exp(rng.gauss(1, 0.8)) for _ in range(20_000)], "left": [-math.exp(rng.gauss(0, 0.5)) for _ in range(20_000)]}
    df = numbers(spark, data)
    want = {r.feature: r.power for r in fit_power(df, list(data)).collect()}
    steps, plain = [], power._moments
    monkeypatch.setattr(power, "_AHEAD", 2000)
    monkeypatch.setattr(power, "_moments", lambda rows, powers: steps.append(rows.count()) or plain(rows, powers))
    got = {r.feature: r.power for r in fit_power(df, list(data)).collect()}
    assert got == pytest.approx(want, abs=1e-9)
    assert max(steps) == 40_000 and 1 <= steps.count(40_000) <= 4


def test_names_and_order_of_products():
    names = [feature_name(t) for t in exponent_table(["a", "b", "c"], 2, bias=True)]
    assert names == ["1", "a", "b", "c", "a^2", "a b", "a c", "b^2", "b c", "c^2"]
    assert [feature_name(t) for t in exponent_table(["a", "b", "c"], 3, True)] == ["a", "b", "c", "a b", "a c", "b c", "a b c"]


def test_products(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 0.0), (2, None, 5.0, 1.0)], "id int, a double, b double, `c d` double")
    first, second = polynomial(df, ["a", "b", "c d"], 2).orderBy("id").collect()
    assert first.asDict() == {"id": 1, "a": 2, "b": 3, "c d": 0, "a^2": 4, "a b": 6, "a c d": 0, "b^2": 9, "b c d": 0, "c d^2": 0}
    assert second["a b"] is None and second["b c d"] == 5
    sparse = sparse_pairs(df, ["a", "b", "c d"], ["id"]).collect()
    wide = {1: first.asDict(), 2: second.asDict()}
    names = [feature_name(t) for t in exponent_table(["a", "b", "c d"], 2)]
    assert {(r.id, r.place, r.feature, r.value) for r in sparse} == {
        (i, names.index(n), n, v) for i, row in wide.items() for n, v in row.items() if n != "id" and v
    }
    with pytest.raises(ValueError, match="duplicate"):
        polynomial(df.withColumnRenamed("id", "a b"), ["a", "b"], 2)
    with pytest.raises(ValueError, match="columns"):
        polynomial(df, [f"x{i}" for i in range(200)], 2)
    with pytest.raises(ValueError, match="degree"):
        polynomial(df, ["a"], 0)


def encoded(spark, rows, smoothing=3.0):
    df = materialise(spark.createDataFrame(rows, "id int, fold int, kind string, target int"), "rows")
    table = materialise(fit_target_encoding(df, ["kind"], "target", smoothing), "encoding")
    return table, {r.id: r.kind_target for r in encode_target(df, table, ["kind"]).collect()}


def some_rows(n=400):
    rng = random.Random(9)
    kinds = ["a", "a", "a", "a", "b", None, "rare"]
    return [(i, rng.randrange(4), rng.choice(kinds) if i else "alone", rng.choice([0, 0, 1, None])) for i in range(n)]


def test_encoding_uses_other_folds_only(spark):
    rows, s = some_rows(), 3.0
    _, found = encoded(spark, rows, s)
    for i, fold, kind, _ in rows:
        others = [(k, t) for _, f, k, t in rows if f != fold and t is not None]
        mean = sum(t for _, t in others) / len(others)
        mine = [t for k, t in others if k == kind]
        assert found[i] == pytest.approx((sum(mine) + s * mean) / (len(mine) + s), rel=1e-12)


def test_targets_of_the_own_fold_do_not_leak(spark):
    rows = some_rows()
    _, before = encoded(spark, rows)
    flipped = [(i, f, k, None if t is None else (1 - t if f == 2 else t)) for i, f, k, t in rows]
    _, after = encoded(spark, flipped)
    assert all(before[i] == after[i] for i, f, _, _ in rows if f == 2)
    assert any(before[i] != after[i] for i, f, _, _ in rows if f != 2)


def test_encoding_of_rows_that_training_has_not_seen(spark, conf):
    rows = some_rows()
    table, _ = encoded(spark, rows)
    labelled = [(k, t) for _, _, k, t in rows if t is not None]
    mean = sum(t for _, t in labelled) / len(labelled)
    for size in (10**6, 1):
        conf("spark.rowtide.broadcastRows", size)
        new = spark.createDataFrame([(1, "a"), (2, "new"), (3, None)], "id int, kind string")
        found = {r.id: r.kind_target for r in encode_target(new, table, ["kind"]).collect()}
        for i, kind in ((1, "a"), (2, "new"), (3, None)):
            mine = [t for k, t in labelled if k == kind]
            assert found[i] == pytest.approx((sum(mine) + 3 * mean) / (len(mine) + 3), rel=1e-12)
        other = spark.createDataFrame([(1, 99, "new")], "id int, fold int, kind string")
        assert encode_target(other, table, ["kind"]).first().kind_target == pytest.approx(mean)
    with pytest.raises(ValueError, match="duplicate"):
        encode_target(new.withColumn("kind_target", F.lit(0)), table, ["kind"])


def test_donors_are_a_permutation_within_folds(spark, conf):
    rows = spark.createDataFrame([(i, i % 3) for i in range(200)], "key int, fold int")
    whole = {r.key: r.donor for r in importance.donors(rows, "key", 5).collect()}
    assert sorted(whole.values()) == list(range(200))
    assert all(a % 3 == b % 3 for a, b in whole.items()) and sum(a != b for a, b in whole.items()) > 150
    conf("spark.rowtide.rowsPerChunk", 10)
    assert {r.key: r.donor for r in importance.donors(rows, "key", 5).collect()} == whole
    assert {r.key: r.donor for r in importance.donors(rows, "key", 6).collect()} != whole


def test_importance_is_zero_for_features_that_no_tree_asks_for(spark):
    train, _, spec = tree_run(spark, SMALL, "metric")
    found = importance.permutation_importance(train, spec).collect()
    assert len(found) == spec.folds * len(spec.features)
    asked = {(r.fold, r.feature) for r in node_table(spark, spec).filter("feature IS NOT NULL").select("fold", "feature").distinct().collect()}
    for r in found:
        assert r.importance == pytest.approx(r.base - r.score, abs=1e-9)
        if (r.fold, r.feature) not in asked:
            assert r.importance == 0
    assert any(r.importance != 0 for r in found)
    means = {r.feature: r.importance for r in importance.mean_importance(spark.createDataFrame(found)).collect()}
    assert len(means) == len(spec.features)


def test_wide_aggregates_are_the_same(spark):
    rows = full_panel(spark, SMALL).selectExpr("nullif(supplier, 3) AS supplier", *FULL.numeric[:40], "flag", "1 AS __rn", "1 AS __n")
    block = {f"{c}_{fn}": f"{fn}(`{c}`)" for c in FULL.numeric[:40] for fn in ("min", "max", "count")}
    block |= {"n000_sum": "sum(`n000`)", "flags": "max(`flag`)", "both": "max(`n000` - `n001`)", "rows": "count(*)"}
    plain, wide = blocks.aggregate(rows, "supplier", block), blocks.aggregate_wide(rows, "supplier", block, least=50)
    assert wide.columns == plain.columns and "inline" in wide._jdf.queryExecution().toString()
    assert wide.exceptAll(plain).isEmpty() and plain.exceptAll(wide).isEmpty()
    assert blocks.aggregate_wide(rows, "supplier", block, least=10_000).columns == plain.columns


def test_wide_aggregates_are_shuffled_in_turns(spark, monkeypatch):
    rows = full_panel(spark, SMALL).selectExpr("nullif(supplier, 3) AS supplier", *FULL.numeric[:40], "flag", "1 AS __rn", "1 AS __n")
    block = {f"{c}_{fn}": f"{fn}(`{c}`)" for c in FULL.numeric[:40] for fn in ("min", "max", "avg", "stddev_samp", "sum", "count")}
    block |= {"flags": "max(`flag`)"}
    stored, real = [], blocks.materialise
    monkeypatch.setattr(blocks, "materialise", lambda df, label: stored.append(len(df.columns)) or real(df, label))
    turns = blocks.aggregate_wide(rows, "supplier", block, least=50, at_once=20)
    assert len(stored) > 1 and max(stored) <= 1 + 20 * 6  # a turn carries 20 columns at most
    plain = blocks.aggregate(rows, "supplier", block)
    shown = [f"round(`{c}`, 6)" for c in plain.columns]
    assert turns.columns == plain.columns and turns.count() == plain.count()
    assert turns.selectExpr(*shown).exceptAll(plain.selectExpr(*shown)).isEmpty()


def test_turns_run_in_code_that_is_compiled(spark, monkeypatch):
    """A few columns get more aggregates: they have turns of their own, and nothing is left to a pass over wide rows."""
    rows = full_panel(spark, SMALL).selectExpr("nullif(supplier, 3) AS supplier", *FULL.numeric[:60], "flag", "1 AS __rn", "1 AS __n")
    block = {f"{c}_{fn}": f"{fn}(`{c}`)" for c in FULL.numeric[:60] for fn in ("min", "max", "avg", "stddev_samp", "count")}
    block |= {f"{c}_{fn}": f"{fn}(`{c}`)" for c in FULL.numeric[:6] for fn in ("sum", "kurtosis")} | {"flags": "max(`flag`)"}
    limits, passes, real, plain = [], [], blocks.materialise, blocks.aggregate
    key = "spark.sql.codegen.hugeMethodLimit"
    monkeypatch.setattr(blocks, "materialise", lambda df, label: limits.append(int(spark.conf.get(key))) or real(df, label))
    monkeypatch.setattr(blocks, "aggregate", lambda df, k, b: passes.append(sorted(b)) or plain(df, k, b))
    before = spark.conf.get(key)
    turns = blocks.aggregate_wide(rows, "supplier", block, least=30, at_once=20)
    assert passes == [["flags"]] and len(limits) == 5 and max(limits) <= 8000
    assert spark.conf.get(key) == before
    want = plain(rows, "supplier", block)
    shown = [f"round(`{c}`, 6)" if c != "flags" else c for c in want.columns]
    assert turns.columns == want.columns and turns.count() == want.count()
    assert turns.selectExpr(*shown).exceptAll(want.selectExpr(*shown)).isEmpty()


def test_wide_aggregates_stay_in_generated_code(spark):
    rows = full_panel(spark, SMALL).selectExpr("*", "1 AS __rn", "1 AS __n")
    block = {f"{c}_{fn}": f"{fn}(`{c}`)" for c in FULL.numeric for fn in ("min", "max", "avg", "stddev_samp", "sum")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = blocks.aggregate_wide(rows, "supplier", block)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    heavy = [line for line in plan.splitlines() if " HashAggregate(" in line]
    assert len(heavy) >= 2 and all("*(" in line for line in heavy)  # a star marks generated code
    assert plan.count("Exchange") <= 2 and "collect_list" in plan


def same_features(grown, rows):
    want = feature_row(rows, ORDERS, GROWING)
    got = grown.features()
    assert got.columns == want.columns
    shown = [F.round(F.col(f"`{c}`").cast("double"), 6).alias(c) for c in want.columns]
    a, b = got.select(*shown), want.select(*shown)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_tables_grow_to_the_same_features(spark, tmp_path):
    rows = orders(spark, SMALL).withColumn("o_totalprice", F.expr("CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END"))
    rows = rows.withColumn("o_orderdate", F.expr("CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate END"))
    grown = FeatureTable(spark, str(tmp_path / "grown"), ORDERS, GROWING)
    with pytest.raises(ValueError, match="nothing"):
        grown.features()
    late, rest = rows.filter("o_orderkey % 3 = 0"), rows.filter("o_orderkey % 3 <> 0")
    assert grown.load(rest, "first")
    same_features(grown, rest)
    assert grown.load(late, "second")
    same_features(grown, rows)
    assert not grown.load(late, "second")  # it is in already
    assert [(v, n) for v, n, _ in grown.loads()] == [(1, "first"), (2, "second")]
    assert sum(n for _, _, n in grown.loads()) == rows.count()
    assert grown.load(rows.limit(0), "nothing new")
    same_features(grown, rows)
    assert grown.forget() == [1, 2]
    same_features(FeatureTable(spark, str(tmp_path / "grown"), ORDERS, GROWING), rows)
    with pytest.raises(ValueError, match="another way"):
        FeatureTable(spark, str(tmp_path / "grown"), ORDERS, GROWING.with_(first=False))
    with pytest.raises(ValueError, match="middle"):
        FeatureTable(spark, str(tmp_path / "other"), ORDERS, GROWING.with_(middle=ORDERS.numeric))


def test_a_stopped_load_starts_again(spark, tmp_path, monkeypatch):
    rows = orders(spark, SMALL)
    half, rest = rows.filter("o_orderkey % 2 = 0"), rows.filter("o_orderkey % 2 = 1")
    grown = FeatureTable(spark, str(tmp_path / "grown"), ORDERS, GROWING)
    grown.load(half, "a")
    plain = spark.createDataFrame

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(spark, "createDataFrame", lost)  # states are written, the manifest is not
    with pytest.raises(RuntimeError, match="lost"):
        grown.load(rest, "b")
    monkeypatch.setattr(spark, "createDataFrame", plain)
    assert [n for _, n, _ in grown.loads()] == ["a"]
    same_features(grown, half)
    assert grown.load(rest, "b")
    same_features(grown, rows)
