"""Whitening against a full eigendecomposition of the covariance of exact integers."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest
from conftest import SMALL
from small import rows_of

from rowtide.llm import queries, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def frame(spark, vectors):
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA).repartition(3)
    for name in ["VEC_ID", "Embedding", "component", "n", "x", "c", "width", "deviation"]:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def checked(found, vectors, components=8):
    """``vectors``: (id, entries) that must be in the result."""
    x = np.array([np.floor(1024 * np.array(v, np.float32).astype(float)).astype(np.int64) + 100_000 for _, v in vectors])
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    centred = np.array([[float(Fraction(int(v)) - Fraction(s, n)) for v, s in zip(row, sums, strict=True)] for row in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-11 * values.sum()).sum()))
    assert len(found) == n * k
    far = {}
    for (i, _), row in zip(vectors, x.tolist(), strict=True):
        far.setdefault(i, set()).add(sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)))
    table = {}
    for r in found:
        assert r["n"] == n and r["deviation"] in far[r["vec_id"]]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
        assert r["identity_error"] <= 1e-9
        table.setdefault(r["component"], {}).setdefault(r["vec_id"], []).append(r["whitened"])
    ids = [i for i, _ in vectors]
    if len(set(ids)) == n:
        white = np.array([[table[c + 1][i][0] for c in range(k)] for i in ids])
        assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-9
        wanted = centred @ axes[:, :k] / np.sqrt(values[:k])
        apart = [i for i in range(k) if min(abs(values[i] - v) for j, v in enumerate(values) if j != i) > 1e-3 * values[0]]
        for i in apart:
            assert min(np.abs(white[:, i] - s * wanted[:, i]).max() for s in (1, -1)) < 1e-8


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    checked(rows_of(queries.op13_whitening(spark, SMALL)), [(r.vec_id, r.embedding) for r in rows])


def cloud(rng, n, d):
    return (rng.standard_normal((n, d)) * np.linspace(1, 0.05, d)).astype(np.float32).tolist()


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    good = list(enumerate(cloud(rng, 80, 12)))
    bad = [
        (None, None),
        (500, []),
        (501, [1.0] * 11),
        (502, [1.0] * 11 + [None]),
        (503, [float("nan")] * 12),
        (504, [float("inf")] + [0.0] * 11),
        (505, [1e30] + [0.0] * 11),
    ]
    again = [(7, good[3][1]), (None, good[5][1]), (7, good[7][1])]
    checked(rows_of(whiten.whitened(frame(spark, good + bad + again))), good + again)


@pytest.mark.parametrize(("n", "d"), [(60, 3), (4, 20), (200, 70)])
def test_few_dimensions_few_vectors_and_wide_vectors(spark, n, d):
    vectors = list(enumerate(cloud(np.random.default_rng(n), n, d)))
    checked(rows_of(whiten.whitened(frame(spark, vectors))), vectors)


def test_passes_damp_the_unwanted_spectrum(spark):
    """A block narrower than the space, without spare columns: several rounds, the same pairs."""
    rng = np.random.default_rng(9)
    vectors = list(enumerate(cloud(rng, 300, 40)))
    data = whiten.prepare(frame(spark, vectors))
    found = whiten.components(data, whiten.Settings(components=4, spare=3))
    assert found.rounds > 2 and (found.residuals < 1e-12).all()
    x = np.array([np.floor(1024 * np.array(v, np.float32).astype(float)) for _, v in vectors])
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert found.values == pytest.approx(values[:4], rel=1e-12)
    assert found.trace == pytest.approx(values.sum(), rel=1e-12)


def test_a_filter_grows_above_its_cut_only():
    values = np.array([10.0, 9.0, 3.0, 2.0, 0.5, 0.0])
    v = np.diag(values)
    times = lambda q: np.concatenate([v @ q, np.zeros((6, 1))], axis=1)
    out = np.diag(whiten._filtered(times, np.eye(6), v, 10.0, 3.0, 8))
    assert out[0] == pytest.approx(1) and abs(out[2:]).max() < 1e-4 and out[1] > 0.1


def test_without_variance(spark):
    assert rows_of(whiten.whitened(spark.createDataFrame([], SCHEMA))) == []
    for same in ([(1, [1.0, 2.0])], [(i, [0.5, 0.25, 0.125]) for i in range(5)], [(1, None), (2, [None])]):
        assert rows_of(whiten.whitened(frame(spark, same))) == []


def test_deviations_are_exact_at_any_size():
    rng = np.random.default_rng(4)
    for n, most in ((1000, 500), (10**9, 10**6), (10**6, 2**40)):
        y, rest = rng.integers(-most, most, (20, 6)), rng.integers(0, n, 6)
        wanted = [sum((n * int(v) - int(r)) ** 2 for v, r in zip(row, rest, strict=True)) for row in y]
        assert whiten._deviations(y, rest, n) == [w if w < 10**38 else None for w in wanted]
