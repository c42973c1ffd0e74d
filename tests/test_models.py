"""Models as tables: engine scores equal the trainer's own; stopping, segments and studies."""

from __future__ import annotations

import itertools
import random
from dataclasses import replace

import pytest
from compare import difference
from conftest import SMALL
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rowtide.catalog.models import network_run, tree_run
from rowtide.operators.metric import metric_components
from rowtide.plans import models, staged, stopping, study
from rowtide.plans.training import _assembled, _inputs, load_model, out_of_fold
from rowtide.session import materialise


@pytest.fixture(scope="module")
def trees(spark):
    return tree_run(spark, SMALL, "metric")


@pytest.fixture(scope="module")
def network(spark):
    return network_run(spark, SMALL)


def close(a, b, on, column="prediction", digits=1e-12):
    both = a.select(*on, F.col(column).alias("a")).join(b.select(*on, F.col(column).alias("b")), on, "full")
    assert both.filter(F.expr(f"a IS NULL OR b IS NULL OR abs(a - b) > {digits}")).isEmpty()
    assert both.count() == a.count() > 0


def test_trees_score_like_the_trainer(spark, trees):
    train, test, spec = trees
    close(models.score_out_of_fold(train, spec), out_of_fold(train, spec), ["o_custkey", "fold"])
    by_model = test.withColumn("label", F.lit(0))
    total = None
    for fold in range(spec.folds):
        part = load_model(spec, fold).transform(_assembled(by_model, spec))
        part = part.select("o_custkey", vector_to_array("probability")[1].alias("p"))
        total = part if total is None else total.unionByName(part)
    close(models.score_blend(test, spec), total.groupBy("o_custkey").agg(F.avg("p").alias("prediction")), ["o_custkey"])


def test_networks_score_like_the_trainer(spark, network):
    train, _, spec, _ = network
    total = None
    for fold in range(spec.folds):
        rows = _inputs(train.filter(F.col("fold") == fold), spec, fold)
        part = load_model(spec, fold).transform(rows).select(
            "o_custkey", "fold", vector_to_array("probability")[1].alias("prediction")
        )
        total = part if total is None else total.unionByName(part)
    close(models.score_out_of_fold(train, spec), total, ["o_custkey", "fold"])


def test_forests_beyond_the_broadcast_bound_go_in_blocks(spark, conf, trees):
    train, _, spec = trees
    whole = materialise(models.score_out_of_fold(train, spec), "whole")
    nodes = models.node_table(spark, spec)
    rows = train.withColumn("target", F.col(spec.target))
    conf("spark.rowtide.broadcastBytes", nodes.count() * models.NODE_BYTES // 3)
    plan = models.tree_parts(rows, nodes, spec, ["o_custkey", "fold"])
    assert "model-block" in plan._jdf.queryExecution().optimizedPlan().toString() or plan.count() == rows.count()
    close(models.score_out_of_fold(train, spec), whole, ["o_custkey", "fold"])


@pytest.mark.parametrize("name", ["oof_predictions", "stopped_predictions", "oof_network_predictions"])
def test_a_constant_predictor_does_not_match(spark, db, name):
    df = entry.queries()[name](spark, SMALL)
    sql = entry.oracle_sql()[name]
    assert difference(df, db, sql) is None
    assert "differ" in difference(df.withColumn("prediction", F.lit(0.5)), db, sql)


def test_margins_after_every_round(spark, trees):
    train, _, spec = trees
    margins = materialise(staged.staged_margins(train, spec), "margins")
    rounds = margins.agg(F.max("iteration")).first()[0]
    assert margins.count() == train.count() * rounds and rounds == 8
    model = load_model(spec, 0)
    rows = _assembled(train.filter("fold = 0"), spec)
    for r in (1, 3, rounds):
        contributions = [
            m.transform(rows).select("o_custkey", (F.col("prediction") * w).alias("part"))
            for m, w in itertools.islice(zip(model.trees, model.treeWeights, strict=True), r)
        ]
        total = contributions[0]
        for c in contributions[1:]:
            total = total.unionByName(c)
        want = total.groupBy("o_custkey").agg(F.sum("part").alias("margin"))
        close(margins.filter(f"fold = 0 AND iteration = {r}"), want, ["o_custkey"], "margin", 1e-8)
    some = staged.staged_margins(train, spec, every=3)
    assert sorted(r[0] for r in some.select("iteration").distinct().collect()) == [3, 6, 8]


def test_running_sums_of_long_arrays(spark):
    values = [random.Random(i).random() for i in range(300)]
    for n in (1, 63, 64, 65, 300):
        (row,) = spark.createDataFrame([(values[:n],)], "parts array<double>").selectExpr(f"{staged._running('parts')} AS sums").collect()
        assert row.sums == pytest.approx(list(itertools.accumulate(values[:n])), rel=1e-12)


def test_curve_is_the_metric_of_each_round(spark, trees):
    train, _, spec = trees
    margins = materialise(staged.staged_margins(train, spec), "margins")
    scores = {(r.fold, r.iteration): r.score for r in staged.curve(margins, "o_custkey").collect()}
    for fold, iteration in [(0, 1), (2, 4), (4, 8)]:
        one = margins.filter(f"fold = {fold} AND iteration = {iteration}")
        assert scores[fold, iteration] == pytest.approx(metric_components(one, "target", "margin", "o_custkey").first()["score"], abs=1e-9)


def simulated(scores, patience, highest=True):
    """(last step, kept step) of a plain loop."""
    best = None
    for step, score in enumerate(scores, 1):
        shown = score if score is not None else (float("-inf") if highest else float("inf"))
        if best is None or (shown > best[1] if highest else shown < best[1]):
            best = (step, shown)
        if step - best[0] >= patience:
            return step, best[0]
    return len(scores), best[0]


@pytest.mark.parametrize("highest", [True, False])
def test_stopping_like_a_loop(spark, highest):
    rng = random.Random(3)
    runs = [[rng.choice([None, *range(6)]) for _ in range(rng.randrange(1, 14))] for _ in range(40)]
    rows = [(i, s, None if v is None else float(v)) for i, run in enumerate(runs) for s, v in enumerate(run, 1)]
    df = spark.createDataFrame(rows, "fold int, iteration int, score double")
    for patience in (1, 3, 50):
        found = staged.stopping(df, patience, highest=highest).collect()
        for i, run in enumerate(runs):
            mine = [r for r in found if r.fold == i]
            last, kept = simulated(run, patience, highest)
            assert [r.iteration for r in mine if r.stopped] == [last]
            assert [r.iteration for r in mine if r.best] == [kept]


def test_kept_trees_end_at_the_best_round(spark, trees):
    train, _, spec = trees
    stops, kept = staged.fit_stopped(train, spec, 3)
    best = {r.fold: r.iteration for r in stops.filter("best").collect()}
    assert {r.fold: r.n for r in kept.groupBy("fold").agg(F.countDistinct("tree").alias("n")).collect()} == best
    assert min(best.values()) < 8  # at least one fold stops early
    with pytest.raises(ValueError, match="another way"):
        staged.fit_stopped(train, spec, 4)
    with pytest.raises(ValueError, match="metric"):
        staged.fit_stopped(train, replace(spec, stop="loss"), 3)


def few(train, spec, tmp_path, name):
    """A network on three features, and its training table."""
    features = spec.features[:3]
    rows = train.select("o_custkey", "target", "fold", *[f"`{f}`" for f in features])
    return rows, replace(spec, features=features, folder=str(tmp_path / name), params=(("hidden", (3,)), ("stepSize", 0.3)))


def test_network_training_stops_and_keeps_the_best_segment(spark, network, tmp_path):
    train, spec = few(network[0], network[2], tmp_path, "run")
    segments = stopping.Segments(steps=5, patience=2, most=30)
    states = stopping.fit_network(train, spec, 0, segments).orderBy("segment").collect()
    losses = [s.loss for s in states]
    assert len(losses) < segments.most  # patience ended it
    assert len(losses) - 1 - losses.index(min(losses)) == segments.patience
    best = states[losses.index(min(losses))]
    assert load_model(spec, 0).weights.toArray().tolist() == list(best.weights)
    curve = stopping.learning_curve(spark.createDataFrame(states).withColumn("fold", F.lit(0)), 2).orderBy("segment").collect()
    assert [r.segment for r in curve if r.best] == [best.segment] and curve[-1].stopped


def test_network_training_goes_on_after_a_stop(spark, network, tmp_path, monkeypatch):
    segments = stopping.Segments(steps=3, patience=3, most=4)
    train, spec = few(network[0], network[2], tmp_path, "whole")
    whole = [(s.segment, s.loss) for s in stopping.fit_network(train, spec, 1, segments).orderBy("segment").collect()]
    train, spec = few(network[0], network[2], tmp_path, "again")
    made, plain = [], stopping.estimator

    def counted(s):
        if len(made) == 2:
            raise RuntimeError("lost")
        made.append(1)
        return plain(s)

    monkeypatch.setattr(stopping, "estimator", counted)
    with pytest.raises(RuntimeError, match="lost"):
        stopping.fit_network(train, spec, 1, segments)
    made.clear()
    found = [(s.segment, s.loss) for s in stopping.fit_network(train, spec, 1, segments).orderBy("segment").collect()]
    assert len(made) == len(whole) - 2
    assert [s for s, _ in found] == [s for s, _ in whole]
    assert [v for _, v in found] == pytest.approx([v for _, v in whole], abs=1e-6)
    made.clear()
    stopping.fit_network(train, spec, 1, segments)
    assert not made  # nothing is trained again


def test_draws_repeat_and_cover_their_range():
    u = [study.drawn(7, t, "a") for t in range(2000)]
    assert u == [study.drawn(7, t, "a") for t in range(2000)] and u != [study.drawn(8, t, "a") for t in range(2000)]
    assert 0 <= min(u) < 0.01 and 0.99 < max(u) < 1 and abs(sum(u) / len(u) - 0.5) < 0.03
    whole = {study.Between(2, 5, whole=True).at(x) for x in u}
    assert whole == {2, 3, 4, 5}
    assert all(0.01 <= study.Between(0.01, 1, log=True).at(x) <= 1 for x in u)
    assert {study.OneOf(("x", "y")).at(x) for x in u} == {"x", "y"}


def test_rungs_shrink_and_grow():
    assert study.Halving(100, 50, 3, 4000).rungs() == [(100, 50), (34, 150), (12, 450), (4, 1350), (2, 4000)]
    assert study.Halving(1, 5, 3).rungs() == [(1, 5)]
    assert study.Halving(5, 4000, 3, 4000).rungs() == [(5, 4000)]


def test_study_prunes_and_goes_on(spark, trees, tmp_path, monkeypatch):
    train, _, spec = trees
    spec = replace(spec, features=("o_totalprice", "status", "o_totalprice_mean"), params=())
    space = {"maxDepth": study.Between(1, 3, whole=True), "stepSize": study.OneOf((0.1, 0.3))}
    halving = study.Halving(trials=4, rounds=1, factor=2)
    seen, plain = [], study._judged

    def judged(*args):
        if len(seen) == 3:
            raise RuntimeError("lost")
        seen.append(1)
        return plain(*args)

    monkeypatch.setattr(study, "_judged", judged)
    with pytest.raises(RuntimeError, match="lost"):
        study.study(train, spec, space, str(tmp_path / "study"), halving)
    seen.clear()
    monkeypatch.setattr(study, "_judged", lambda *a: seen.append(1) or plain(*a))
    rows = study.study(train, spec, space, str(tmp_path / "study"), halving).collect()
    assert len(seen) == 4 + 2 + 1 - 3
    by_rung = {k: [r for r in rows if r.rung == k] for k in range(3)}
    assert [len(by_rung[k]) for k in range(3)] == [4, 2, 1]
    for k in range(2):
        order = sorted(by_rung[k], key=lambda r: (-r.score, r.trial))
        assert [r.place for r in order] == list(range(1, len(order) + 1))
        assert {r.trial for r in order if r.survives} == {r.trial for r in by_rung[k + 1]}
    with pytest.raises(ValueError, match="another way"):
        study.study(train, spec, space, str(tmp_path / "study"), halving, seed=8)
