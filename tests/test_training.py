"""Training protocol: every row scored once by a model that has not seen it; runs repeat."""

from dataclasses import replace

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from rowtide.catalog.training import panels
from rowtide.operators.folds import fixed_sample, stratified_folds
from rowtide.operators.metric import mean_score
from rowtide.plans.search import grid, search
from rowtide.plans.training import fold_scores, out_of_fold, score_panel
from rowtide.session import materialise


@pytest.fixture(scope="module")
def trees(spark):
    return panels(spark, SMALL, "trees")


@pytest.fixture(scope="module")
def train(trees):
    return trees[0].select("o_custkey", "target", "fold", "o_totalprice", "`o_totalprice-mean`", "status")


@pytest.mark.parametrize("model", ["trees", "network"])
def test_out_of_fold_and_scores_of_unseen_rows(spark, trees, model):
    train, test, spec = trees if model == "trees" else panels(spark, SMALL, model)
    assert len(spec.features) == len(train.columns) - 3 > 25
    first = materialise(out_of_fold(train, spec), "oof")
    assert first.count() == train.count() == first.select("o_custkey").distinct().count()
    low, high = first.agg(F.min("prediction"), F.max("prediction")).first()
    assert 0 <= low <= high <= 1
    again = out_of_fold(train, spec)  # models are loaded, not trained again
    assert again.exceptAll(first).isEmpty()

    scores = fold_scores(first, "o_custkey")
    assert scores.count() == 5 and mean_score(scores).first()["folds"] == 5

    mixed = score_panel(train, test, spec)
    assert mixed.columns == ["o_custkey", "prediction"] and mixed.count() == test.count()
    assert mixed.filter("prediction IS NULL OR prediction NOT BETWEEN 0 AND 1").isEmpty()
    assert mixed.join(train, "o_custkey").isEmpty()
    with pytest.raises(ValueError, match="differ"):
        score_panel(train, test.withColumn(spec.features[0], F.lit("text")), spec)
    with pytest.raises(ValueError, match="another way"):
        out_of_fold(train, replace(spec, seed=7))


def test_folds_are_balanced_and_repeat(spark, train):
    base = train.drop("fold")
    folds = stratified_folds(base, "o_custkey", "target", folds=5, seed=7)
    sizes = folds.groupBy("target").pivot("fold").count().collect()
    for row in sizes:
        counts = list(row)[1:]
        assert max(counts) - min(counts) <= 1
    again = stratified_folds(base.repartition(9), "o_custkey", "target", folds=5, seed=7)
    assert again.exceptAll(folds).isEmpty()
    other = stratified_folds(base, "o_custkey", "target", folds=5, seed=8)
    assert not other.exceptAll(folds).isEmpty()


def test_sample_is_exact_and_repeats(train):
    a = fixed_sample(train, "o_custkey", 20)
    assert a.count() == 20
    assert a.exceptAll(fixed_sample(train.repartition(5), "o_custkey", 20)).isEmpty()


def test_search_orders_candidates(spark, train, trees):
    spec = replace(trees[2], features=("o_totalprice", "o_totalprice-mean", "status"), params=())
    out = search(train, spec, grid({"maxDepth": [1, 3], "maxIter": [2]})).collect()
    assert sorted(r["candidate"] for r in out) == [0, 1]
    assert out[0]["score"] >= out[1]["score"]


def test_unknown_model_is_refused(train, trees, tmp_path):
    with pytest.raises(ValueError, match="trees"):
        out_of_fold(train, replace(trees[2], model="forest", features=("status",), folder=str(tmp_path)))
