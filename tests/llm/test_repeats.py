"""Repeat removal against every window in plain Python."""

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from small import documents, empty, rows_of

from rowtide import session
from rowtide.llm import bwt, repeats
from rowtide.llm.common import pick

LAST = 1 << 63


def brute(rows, length=100):
    """[(doc_id, n_bytes, n_removed, n_spans, sha256)] of (doc_id, text)."""
    first = {}
    data = [(LAST if d is None else d, (t or "").encode()) for d, t in rows]
    for d, raw in data:
        for i in range(len(raw) - length + 1):
            key = raw[i : i + length]
            first[key] = min(first.get(key, (d, i)), (d, i))
    out = []
    for (doc_id, _), (d, raw) in zip(rows, data, strict=True):
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < (d, i):
                gone[i : i + length] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **options):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r[n] for n in names) for r in rows_of(repeats.strip_repeats(df, **options))), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(2, 9)))
    passages = [" ".join(word() for _ in range(rng.randrange(15, 60))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(1, 40)))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(0, 30)
            parts += [p[a : a + rng.randrange(80, 400)], word()]
        if i % 9 == 0:
            parts.append(rng.choice("xy") * rng.randrange(90, 400))
        rows.append((rng.randrange(1000), "".join(parts)))
    rows += [(2000, rows[3][1]), (rows[5][0], rows[5][1]), (rows[6][0], rows[7][1]), (None, rows[8][1]), (None, rows[8][1]), (1, "ab" * 60)]
    base = list(rows[10][1])
    for i in range(8):
        copy = list(base)
        copy[rng.randrange(len(copy))] = "#"
        rows.append((3000 + i, "".join(copy)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_window_is_judged(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert got(df) == want
    assert sum(w[2] > 0 for w in want) > 20


def test_large_collections_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH", 700)
    monkeypatch.setattr(repeats, "SHARD", 200)
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df) == brute(rows)


def test_real_and_awkward_rows(spark):
    df = documents(spark, 60)
    rows = [(r["doc_id"], r["text"]) for r in rows_of(pick(df, "doc_id", "text"))]
    short = [(d, t if t is None or len(t) < 50_000 else t[:3000]) for d, t in rows]
    frame = spark.createDataFrame(short, "doc_id long, text string")
    assert got(frame) == brute(short)
    long = {r[0]: r for r in got(df)}
    # The first window of a run stays, everything after it repeats.
    assert long[907][2] == 200_000 - 1 and long[906][2] == 150_000 - 5


def test_what_a_step_stored_goes_with_it(spark, monkeypatch):
    """Texts are stored nowhere, and only what the result reads is left."""
    made = []

    def stored(df, label, **options):
        out = session.stored(df, label, **options)
        made.append((label, df.columns, Path(out[1])))
        return out

    monkeypatch.setattr(repeats, "stored", stored)
    monkeypatch.setattr(repeats, "materialise", lambda df, label: stored(df, label)[0])
    monkeypatch.setattr(repeats, "BATCH", 700)
    rows = corpus(6)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df) == brute(rows)
    assert {label for label, _, path in made if path.exists()} <= {"repeats-rows", "repeats-classes", "repeats-sizes", "repeats-left"}
    assert not any("text" in columns for _, columns, _ in made)


@pytest.mark.parametrize("text", [b"x" * 300, b"ab" * 70, b"abcdefgh" * 40 + b"q", bytes(range(200)), b"z"])
def test_suffixes_are_in_order(text):
    ring = text * (100 // len(text) + 2)
    order = bwt.suffix_order(np.frombuffer(text, np.uint8), 100).tolist()
    shown = [ring[i : i + 100] for i in order]
    assert shown == sorted(shown) and sorted(order) == list(range(len(text)))


def test_other_lengths(spark):
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, length=64) == brute(rows, 64)


def test_empty(spark):
    assert repeats.strip_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_merged_transforms_find_equal_prefixes(seed):
    rng = np.random.default_rng(seed)
    letters = [2, 3, 200, 30, 4, 60][seed]
    shards = [rng.integers(0, letters, n).astype(np.uint8) for n in ([40, 1, 300], [5000, 4000], [60_000, 50_000], [500] * 9, [7], [900, 0, 800])[seed]]
    common = rng.integers(0, letters, 300).astype(np.uint8)
    shards = [np.concatenate([s, common, s[:50]]) if len(s) > 100 else s for s in shards]
    shard, start, interval = bwt.merge(shards, 100)
    held = [s for s in shards if len(s)]
    rings = [np.concatenate([s] * (100 // len(s) + 2)).tobytes() for s in held]
    strings = [rings[s][a : a + 100] for s, a in zip(shard.tolist(), start.tolist(), strict=True)]
    assert strings == sorted(strings)
    assert len(strings) == sum(map(len, held)) and len(set(zip(shard.tolist(), start.tolist(), strict=True))) == len(strings)
    same = [a == b for a, b in zip(strings, strings[1:], strict=False)]
    assert same == (np.diff(interval) == 0).tolist()


@pytest.mark.parametrize("text", [b"x" * 500, bytes(range(250)) * 3, b"ab" * 200, b"q" * 100])
def test_every_window_has_an_anchor_that_its_content_sets(text):
    raw = np.frombuffer(text, np.uint8)
    place, keys = repeats.anchors(raw, 100)
    for i in range(len(raw) - 99):
        inside = {(p - i, k) for p, k in zip(place.tolist(), keys.tolist(), strict=True) if i <= p <= i + 68}
        alone = repeats.anchors(raw[i : i + 100], 100)
        assert set(zip(alone[0].tolist(), alone[1].tolist(), strict=True)) <= inside and len(alone[0])
