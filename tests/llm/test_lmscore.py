"""Language-model scores against plain dictionaries of exact counts, quantised by the same levels."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from small import documents, empty, rows_of
from rowtide.llm import lmscore
from rowtide.llm.common import pick
from rowtide.llm.logbloom import filled, floors, joined, shard_of, within_shard

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SHARP = lmscore.Settings(bits_per_event=512, hashes=12)  # a filter that errs about once in 10**9 probes


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def brute(rows, s):
    """{(doc_id, text): expected values}"""
    grams = Counter()
    for r in rows:
        if not is_held_out(r["doc_id"]):
            line = [None, *tokens_of(r["text"])]
            for i in range(1, len(line)):
                for n in range(1, s.order + 1):
                    # An end is only the first or the last token of a gram.
                    if i - n + 1 >= 0 and None not in line[i - n + 2 : i]:
                        grams[tuple(line[i - n + 1 : i + 1])] += 1
    total = sum(c for g, c in grams.items() if len(g) == 1)
    vocabulary = sum(len(g) == 1 for g in grams)
    edges = floors(s.base).tolist()

    def level(gram):
        return max(j for j, e in enumerate(edges) if e <= grams[gram])

    def low(gram):
        return edges[level(gram)]

    def high(gram):
        return edges[level(gram) + 1] - 1

    out = {}
    for r in rows:
        line = [None, *tokens_of(r["text"])]
        base = score = known = 0
        for i in range(1, len(line)):
            c = grams[(line[i],)]
            known += c > 0
            base += math.log10((c + 0.1) / (total + 0.1 * (vocabulary + 1)))
            p = (low((line[i],)) + 0.1) / (total + 0.1 * (vocabulary + 1))
            for n in range(2, s.order + 1):
                if i - n + 1 < 0 or None in line[i - n + 2 : i]:
                    break
                gram = tuple(line[i - n + 1 : i + 1])
                p = (low(gram) + s.priors[n - 2] * p) / (high(gram[:-1]) + s.priors[n - 2])
            score += math.log10(p)
        out[r["doc_id"], r["text"]] = (is_held_out(r["doc_id"]), len(line) - 1, known, total, base, score)
    return out


def same(found, rows, expected):
    texts = {}
    for r in rows:
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert sorted(map(str, (r["doc_id"] for r in found))) == sorted(str(r["doc_id"]) for r in rows)
    for r in found:
        got = (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"])
        wanted = [expected[r["doc_id"], t] for t in texts[r["doc_id"]]]
        assert any(
            got == w[:4] and r["base_score"] == pytest.approx(w[4], rel=1e-12) and r["score"] == pytest.approx(w[5], rel=1e-9)
            for w in wanted
        ), r


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_like_plain_dictionaries(spark, order):
    docs = documents(spark, 60)
    s = replace(SHARP, order=order, priors=(40.0, 10.0, 5.0))
    rows = rows_of(pick(docs, "doc_id", "text"))
    same(rows_of(lmscore.lm_scores(docs, s)), rows, brute(rows, s))


def test_probes_by_shuffle_give_the_same_doubles(spark, conf, monkeypatch):
    monkeypatch.setattr(lmscore, "PER_SHARD", 512)  # many shards
    lines = lmscore.read(documents(spark, 60, awkward=False))
    assert lines.table.count() >= 3
    model = lmscore.train(lines)
    assert model.shard_bits > 3
    key = lambda r: r["doc_id"]
    near = sorted(rows_of(lmscore.score(lines, model)), key=key)
    conf("spark.rowtide.broadcastBytes", 1)
    assert sorted(rows_of(lmscore.score(lines, model)), key=key) == near
    again, answers = lmscore._trained(lines, answer=True)
    assert sorted(rows_of(lmscore._by_answers(lines, again, answers)), key=key) == near
    assert "CoGroup" in lmscore.score(lines, model)._jdf.queryExecution().toString()


def test_awkward_rows_by_shuffle(spark, conf):
    conf("spark.rowtide.broadcastBytes", 1)
    docs = documents(spark, 20)
    rows = rows_of(pick(docs, "doc_id", "text"))
    same(rows_of(lmscore.lm_scores(docs, SHARP)), rows, brute(rows, SHARP))


def test_texts_that_the_model_has_not_read(spark, conf):
    """Scores of a text hang on the model only, not on the texts beside it, in both ways."""
    docs = documents(spark, 60, awkward=False, extra=False)
    model = lmscore.train(lmscore.read(docs))
    whole = {r["doc_id"]: r for r in rows_of(lmscore.score(lmscore.read(docs), model))}
    few = lmscore.read(docs.filter("doc_id % 7 = 0"))
    for size in (10**9, 1):
        conf("spark.rowtide.broadcastBytes", size)
        for r in rows_of(lmscore.score(few, model)):
            assert r == whole[r["doc_id"]]


def test_empty_and_only_held_out(spark):
    assert rows_of(lmscore.lm_scores(empty(spark))) == []
    alone = spark.createDataFrame([(None, "some words here")], "doc_id bigint, text string")
    (row,) = rows_of(lmscore.lm_scores(alone))
    assert row["held_out"] and row["train_tokens"] == 0 and row["n_known"] == 0
    assert row["base_score"] == 0 and row["n_tokens"] == 4


def test_held_out_texts_fit_better_than_by_single_tokens(spark):
    found = rows_of(lmscore.lm_scores(documents(spark, 200, awkward=False)))
    unseen = [r for r in found if r["held_out"]]
    assert unseen and sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_least_counts_of_a_history_are_within_its_greatest_count():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choice(words, 40, p=np.arange(1, 13) / 78)) for _ in range(60)]
    s = SHARP
    least, most = floors(s.base)[:-1], floors(s.base)[1:] - 1
    counts = Counter(zip(*[sum((t.split() for t in texts), [])[i:] for i in (0, 1)], strict=False))
    history = sum(c for (h, _), c in counts.items() if h == "w11")
    level = lambda c: int(np.searchsorted(floors(s.base), c, side="right") - 1)
    assert sum(least[level(c)] for (h, _), c in counts.items() if h == "w11") <= most[level(history)]


def test_filter_is_never_too_low_and_seldom_too_high():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 63, 60_000, dtype=np.uint64) * np.uint64(2))
    counts = np.minimum((rng.pareto(1.1, len(keys)) + 1), 1e12).astype(np.int64)
    bits = 3
    shards = shard_of(keys, bits)
    parts = [
        (s, filled(within_shard(keys[shards == s], bits), counts[shards == s], 1.25, 12, 5)) for s in range(7)
    ]  # the last shard is missing
    table = joined(parts, bits, 5)
    wanted = np.searchsorted(floors(1.25), counts, side="right") - 1
    found = table.levels(keys)
    assert (found[shards == 7] == 0).all()
    held = shards < 7
    assert (found[held] >= wanted[held]).all()
    assert (found[held] > wanted[held]).mean() < 0.02
    strangers = rng.integers(0, 1 << 63, 60_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    assert (table.levels(strangers) > 0).mean() < 0.02


def test_levels_of_small_counts_are_exact():
    edges = floors(1.25)
    assert edges[:6].tolist() == [0, 1, 2, 3, 4, 5]
    assert (np.diff(edges[1:]) > 0).all() and len(edges) <= 256


def test_long_texts_are_cut_between_words(monkeypatch):
    whole = lmscore._words(["ab cde\tf " * 50 + "x" * 300 + " tail\n"])[0]
    monkeypatch.setattr(lmscore, "PIECE", 40)
    assert (lmscore._words(["ab cde\tf " * 50 + "x" * 300 + " tail\n"])[0] == whole).all()
    assert (lmscore._words(["x" * 300])[0] == lmscore._words(["x" * 300, "y"])[0][:1]).all()
