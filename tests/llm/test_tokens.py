"""Token ids, packing, plane files and flat scans against whole-text encoding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from small import AWKWARD, documents, empty, frame, rows_of
from tokenizers import Tokenizer

from rowtide.llm import flatscan, packing, tokenfile, tokens
from rowtide.llm.common import pick

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["a  b", " lead", "trail ", "\n x\n\n y", "don't  stop", "é ́x", "<|endoftext|> a", "x <|endoftext|>", "x  <|endoftext|>y", "<|startoftext|>b", "A<|ENDOFTEXT|> \n <|endoftext|><|endoftext|>", "İ ß", "1 2 3  ", "tab\t \tz", "  "]


@pytest.mark.parametrize("ordinary", [False, True])
@pytest.mark.parametrize(("path", "spaced"), [(BYTE, True), (WORD, False)])
def test_ids_are_those_of_the_whole_text(path, spaced, ordinary, monkeypatch):
    texts = [r[1] or "" for r in AWKWARD] + ODD + frame(60).text.tolist()
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = ordinary
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for cache in (tokens.CACHE, 50):
        monkeypatch.setattr(tokens, "CACHE", cache)
        encoder = tokens.Encoder(path, spaced, ordinary)
        for _ in range(2):
            assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == want


def ids_of(path, end, ordinary=False):
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = ordinary
    return lambda text: [*whole.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_holds_each_id_once_without_gaps(spark):
    df = documents(spark)
    want = defaultdict(list)
    encode = ids_of(BYTE, 0)
    for r in rows_of(pick(df, "doc_id", "text")):
        want[r["doc_id"]].append(encode(r["text"]))
    pieces = rows_of(packing.pack(df, BYTE))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(want)
    for doc_id, docs in want.items():
        need = sorted((a, len(d[a : a + 1024]), crc(d[a : a + 1024]), len(d)) for d in docs for a in range(0, len(d), 1024))
        assert need == sorted((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in by_doc[doc_id])
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= 1024


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    rng = random.Random(seed)
    histogram = {n: rng.randrange(1, 40) for n in rng.sample(range(1, 65), 30)}
    where = packing.places(packing.plan(histogram, 64))
    taken = defaultdict(list)
    for length, n in histogram.items():
        first, base, offset = where[length]
        for rank in range(n):
            at = np.searchsorted(first, rank, "right") - 1
            taken[base[at] + rank - first[at]].append((offset[at], length))
    for held in taken.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64


@pytest.mark.parametrize("width", [tokenfile.BYTE, tokenfile.BIT])
def test_plane_files_round_trip(spark, width):
    df = documents(spark)
    encode = ids_of(WORD, 2)
    rows = sorted(rows_of(pick(df, "doc_id", "text")), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    manifest = tokenfile.write(df, WORD, False, 2, width=width, block=1000)
    got = sorted(rows_of(tokenfile.read(manifest)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in rows]
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    want = defaultdict(list)
    for r in rows:
        ids = encode(r["text"])
        want[r["doc_id"]].append((len(ids), crc(ids)))
    have = defaultdict(list)
    for r in got:
        have[r["doc_id"]].append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("width", [tokenfile.BYTE, tokenfile.BIT])
def test_planes_of_any_ids(width):
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 2**32, 777, dtype=np.uint32), np.zeros(8, np.uint32), np.array([1], np.uint32)):
        planes = tokenfile.to_planes(ids, width)
        assert (tokenfile.from_planes(planes, len(ids), width) == ids).all()


@pytest.mark.parametrize("block", [7, 1000, flatscan.BLOCK_IDS])
def test_flat_scan_finds_every_document(spark, block):
    df = pick(documents(spark), "doc_id", "text").filter("length(text) < 2000 OR text IS NULL")
    encode = ids_of(BYTE, 50256, ordinary=True)
    folder, order = flatscan.write_flat(df, BYTE, True, 50256)
    got = rows_of(flatscan.count_tokens(flatscan.listed(spark, folder), 50256, block_ids=block))
    by_file = {(r["file"].rsplit("/")[-1], r["ordinal"]): r for r in got}
    wanted = rows_of(df)
    sizes = defaultdict(list)
    for r in wanted:
        sizes[r["doc_id"]].append(len(encode(r["text"])) - 1)
    have = defaultdict(list)
    for r in rows_of(order):
        have[r["doc_id"]].append(by_file[r["file"].rsplit("/")[-1], r["ordinal"]]["n_tokens"])
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in sizes.items()}
    assert len(got) == len(wanted) and all(r["terminated"] for r in got)


def test_flat_scan_of_odd_files(spark, tmp_path):
    flat = {"empty": [], "only": [9], "open": [1, 2, 9, 3], "run": [9, 9, 1, 9], "none": [1, 2, 3, 4, 5]}
    for name, ids in flat.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    got = defaultdict(list)
    for r in rows_of(flatscan.count_tokens(flatscan.listed(spark, str(tmp_path)), 9, block_ids=2)):
        got[r["file"].rsplit("/")[-1]].append((r["ordinal"], r["start"], r["n_tokens"], r["terminated"]))
    assert {k: sorted(v) for k, v in got.items()} == {
        "only": [(0, 0, 0, True)],
        "open": [(0, 0, 2, True), (1, 3, 1, False)],
        "run": [(0, 0, 0, True), (1, 1, 0, True), (2, 2, 1, True)],
        "none": [(0, 0, 5, False)],
    }


def test_empty(spark):
    assert packing.pack(empty(spark), BYTE).count() == 0
    assert tokenfile.read(tokenfile.write(empty(spark), WORD, False, 2)).count() == 0
    folder, order = flatscan.write_flat(empty(spark), BYTE, True, 50256)
    assert order.count() == 0 and flatscan.count_tokens(flatscan.listed(spark, folder), 50256).count() == 0
