"""The similarity join against all pairs in plain Python."""

import random
import re

import numpy as np
import pytest
from small import documents, empty, rows_of

from rowtide.llm import jaccard, sigtree, words
from rowtide.llm.common import pick
from rowtide.llm.components import components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def brute(rows, size, percent):
    """{doc_id: least reachable doc_id} over rows of (doc_id, text)."""
    sets = [(d, shingles(t, size)) for d, t in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: find(d) for d in root}, sets


def edited(rng, base, edits, fresh):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{next(fresh)}"
    return " ".join(out)


def corpus(seed):
    """Families of near copies around the threshold, chains, passages that many texts share, short texts."""
    rng, fresh = random.Random(seed), iter(range(10**9))
    rows, passage = [], [f"p{i}" for i in range(30)]
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 7, 12, 40, 90, 250]))]
        for _ in range(rng.randrange(2, 9)):
            text = edited(rng, base, rng.randrange(0, max(2, len(base) // 18)), fresh)
            rows.append(text.upper() if rng.random() < 0.2 else text.replace(" ", rng.choice([" ", "\n", " \t"])))
    link = [f"c{i}" for i in range(120)]
    for _ in range(12):
        link[rng.randrange(120)] = f"new{next(fresh)}"
        rows.append(" ".join(link))
    for _ in range(25):
        own = [f"u{next(fresh)}" for _ in range(rng.randrange(5, 40))]
        rows.append(" ".join(own[: len(own) // 2] + passage + own[len(own) // 2 :]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "size", "percent", "block"), [(1, 4, 85, 512), (2, 5, 80, 512), (3, 4, 85, 3), (4, 2, 60, 4)])
def test_components_are_those_of_all_pairs(spark, seed, size, percent, block):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in rows_of(jaccard.jaccard_components(df, size, percent, block))}
    want, sets = brute(rows, size, percent)
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(got[d]["n_shingles"] == len(s) for d, s in sets)
    assert len(set(want.values())) < len(rows) - 20


def test_real_and_awkward_rows(spark):
    df = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in rows_of(pick(df, "doc_id", "text"))]
    want, _ = brute(rows, 4, 85)
    got = rows_of(jaccard.jaccard_components(df, 4, 85))
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    assert {r["n_shingles"] for r in got if r["doc_id"] in (901, 902, 903)} == {0}


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, "x"), (3, text, "y"), (3, text, "y"), (9, text + " more", "z"), (7, "else", "q"), (None, text, "n"), (8, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(((r["doc_id"], r["lang"]) for r in rows_of(jaccard.keep_one(df))), key=str)
    assert got == [(3, "y"), (7, "q"), (8, "e")]  # the row without an id is a copy


def test_rows_that_share_a_doc_id_connect_their_texts(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    df = spark.createDataFrame([(1, one), (2, two), (7, one), (7, two), (8, two)], "doc_id long, text string")
    assert {r["component_id"] for r in rows_of(jaccard.jaccard_components(df, 4, 85))} == {1}


def test_empty(spark):
    assert jaccard.jaccard_components(empty(spark)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 57, 200])
def test_long_chains_become_one_component(spark, n):
    links = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(1000, 1001)], "a long, b long")
    got = {r["v"]: r["p"] for r in rows_of(components(links))}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


@pytest.mark.parametrize("seed", range(4))
def test_traversal_prunes_no_linked_pair(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(5, 200)), rng.integers(0, 2**63, 5, dtype=np.uint64)])) for _ in range(90)]
    sets += [s[: max(1, len(s) - 2)] for s in sets[:30]]
    for num, den in ((85, 100), (30, 100)):
        for bits in (64, 256, 4096):
            tree = sigtree.Tree(sigtree.bitmaps(sets, bits), np.array([len(s) for s in sets]))
            kept = set(zip(*[x.tolist() for x in sigtree.candidate_pairs(tree, num, den)], strict=True))
            linked = {(i, j) for j in range(len(sets)) for i in range(j) if sigtree.linked(sets[i], sets[j], num, den)}
            assert linked <= kept
            assert bits < 4096 or len(kept) < len(sets) ** 2 / 2


@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_share_a_route(seed):
    rng = np.random.default_rng(seed)
    for n in (5, 6, 9, 30, 200, 3000):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for _ in range(20):
            cut = rng.integers(0, n // 8 + 2)
            b = np.unique(np.concatenate([np.delete(a, rng.choice(len(a), min(cut, len(a) - 1), replace=False)), rng.integers(0, 2**64, rng.integers(0, n // 8 + 2), dtype=np.uint64)]))
            if not np.array_equal(a, b) and sigtree.linked(a, b, 85, 100):
                keys, owner = jaccard.routes(np.concatenate([a, b]), np.array([len(a), len(b)]), 85, 100)
                assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())


def test_shingles_depend_on_words_only():
    texts = ["A b\tC d e", "a B\n\nc  D E ", "a b", "", " ", "a b c d x", "é b c d", "b a"]
    hashes, counts = words.shingle_sets(texts, 4)
    assert counts.tolist() == [2, 2, 1, 0, 0, 2, 1, 1]
    parts = np.split(hashes, np.cumsum(counts)[:-1])
    assert np.array_equal(parts[0], parts[1]) and len(np.intersect1d(parts[0], parts[5])) == 1
    alone = [words.shingle_sets([t], 4)[0].tolist() for t in texts]
    assert alone == [p.tolist() for p in parts]


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_leave_every_linked_set_undecided(seed):
    rng = np.random.default_rng(seed)
    base = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (20, 300, 320, 900)]
    sets = []
    for b in base * 12:
        fresh = rng.integers(0, 2**64, rng.integers(1, len(b) // 4), dtype=np.uint64)
        sets.append(np.unique(np.concatenate([rng.choice(b, len(b) - len(fresh), replace=False), fresh])))
    sizes, labels = np.array([len(s) for s in sets]), np.arange(len(sets))
    bits = min(sigtree.width(n) for n in sizes)
    words = np.stack([sigtree.folded(sigtree.bitmap(s, sigtree.width(len(s))), bits) for s in sets])
    assert np.array_equal(words, sigtree.bitmaps(sets, bits))
    left = sigtree.undecided(words, sizes, labels, 80, 100)
    linked = {k for i in range(len(sets)) for j in range(i) if sigtree.linked(sets[i], sets[j], 80, 100) for k in (i, j)}
    assert linked and linked <= set(np.flatnonzero(left).tolist())
    assert not sigtree.undecided(words, sizes, np.zeros(len(sets), int), 80, 100).any()


@pytest.mark.parametrize("few", [1000, 0])
def test_open_trees_are_met_with_thin_bitmaps(spark, conf, monkeypatch, few):
    """Trees that are not all connected take little of each set at first, and only the sets that are left then."""
    conf("spark.rowtide.broadcastRows", few)  # 0: sets that are left are found without a broadcast
    met, plain = [], jaccard._undecided

    def spied(members, *rest):
        met.append(members.selectExpr("count(*)", "sum(8 * length(bits)) / sum(n)").first())
        return plain(members, *rest)

    monkeypatch.setattr(jaccard, "_undecided", spied)
    shared = [f"s{i}" for i in range(100)]
    rows = [(d, " ".join([*shared, *[f"o{d // 2}x{i}" for i in range(60 + d // 2)], f"end{d}"])) for d in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in rows_of(jaccard.jaccard_components(df, 3, 85, 4))}
    assert got == brute(rows, 3, 85)[0]
    assert met[0][0] > 0 and met[0][1] <= 2.2
    assert met[-1][0] < met[0][0]


@pytest.mark.parametrize("seed", range(3))
def test_linked_sets_share_a_route_in_any_order_of_shingles(seed):
    rng = np.random.default_rng(seed)
    often = rng.integers(0, 65536, jaccard._BUCKETS, dtype=np.uint16)
    met = 0
    for n in (1, 2, 4, 5, 30, 700):
        for _ in range(40):
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            cut, fresh = rng.integers(0, n // 6 + 2, 2)
            b = np.unique(np.concatenate([rng.choice(a, max(1, len(a) - cut), replace=False), rng.integers(0, 2**64, fresh, dtype=np.uint64)]))
            if not np.array_equal(a, b) and sigtree.linked(a, b, 80, 100):
                keys, owner = jaccard.routes(np.concatenate([a, b]), np.array([len(a), len(b)]), 80, 100, often)
                assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())
                met += 1
    assert met > 20


def test_a_common_passage_is_no_route(spark, monkeypatch):
    """Texts that share a passage, but are not linked by it, meet in no tree; near copies of them do."""
    rng, passage = random.Random(5), [f"p{i}" for i in range(60)]
    own = [[f"u{d}x{i}" for i in range(80)] for d in range(150)]
    rows = [(d, " ".join(w[:40] + passage + w[40:])) for d, w in enumerate(own)]
    rows += [(d + 200, " ".join(w[:40] + passage + w[40:79] + ["other"])) for d, w in enumerate(own[:20])]
    rng.shuffle(rows)
    met, plain = [], jaccard.routing.led

    def spied(*args):
        found = plain(*args)
        met.append(found.count())
        return found

    monkeypatch.setattr(jaccard.routing, "led", spied)
    monkeypatch.setattr(jaccard, "_FEW", 0, raising=False)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    counted = jaccard._often(df, 5)
    assert counted.sum() == sum(len(shingles(t, 5)) for _, t in rows) and counted.max() >= len(rows)
    got = {r["doc_id"]: r["component_id"] for r in rows_of(jaccard.jaccard_components(df, 5, 80))}
    assert got == brute(rows, 5, 80)[0]
    assert got[200] == 0 and len(set(got.values())) == 150
    assert len(met) == 1 and 20 <= met[0] <= 40


def test_meetings_in_an_open_tree_are_bounded(spark, monkeypatch):
    """Sets that are apart from a tree's leader meet its blocks in parts, however many they are."""
    met, plain = [], jaccard._undecided

    def spied(members, *rest):
        sizes = members.groupBy("leader", "block").count()
        met.append((members.select("digest").distinct().count(), sizes.agg({"count": "max"}).first()[0]))
        return plain(members, *rest)

    monkeypatch.setattr(jaccard, "_undecided", spied)
    shared = [f"s{i}" for i in range(100)]
    rows = [(d, " ".join([*shared, *[f"o{d // 2}x{i}" for i in range(60)], f"end{d}"])) for d in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in rows_of(jaccard.jaccard_components(df, 3, 85, 8))}
    assert got == brute(rows, 3, 85)[0]
    assert met[0][0] > 100 and met[0][1] <= 48


@pytest.mark.parametrize("block", [512, 16])
def test_only_sets_that_may_be_linked_fetch_their_texts(spark, monkeypatch, block):
    """Texts that meet by a shared passage are told apart by bitmaps first, also those of different blocks."""
    rng, passage = random.Random(6), [f"p{i}" for i in range(60)]
    own = [[f"u{d}x{i}" for i in range(80)] for d in range(150)]
    rows = [(d, " ".join(w[:40] + passage + w[40:])) for d, w in enumerate(own)]
    rows += [(d + 200, " ".join(w[:40] + passage + w[40:79] + ["other"])) for d, w in enumerate(own[:20])]
    rng.shuffle(rows)
    met, fetched, plain, sets = [], [], jaccard.routing.led, jaccard._sets

    def spied(*args):
        found = plain(*args)
        met.append(found.select("node").distinct().count())
        return found

    def counted(docs, wanted, size):
        fetched.append(wanted.select("digest").distinct().count())
        return sets(docs, wanted, size)

    monkeypatch.setattr(jaccard.routing, "led", spied)
    monkeypatch.setattr(jaccard, "_sets", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in rows_of(jaccard.jaccard_components(df, 5, 80, block))}
    assert got == brute(rows, 5, 80)[0]
    assert got[200] == 0 and len(set(got.values())) == 150
    assert met[0] > 140 and 40 <= fetched[0] <= 60
