"""Quality rules: base measures and the line limits against plain Python."""

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
from compare import difference
from small import SCHEMA, documents, empty, rows_of

from rowtide.llm import quality, sql
from rowtide.llm.common import pick

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def base(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    again = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return (
        len(words),
        sum(len(w) for w in words),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(again),
    )


def normal(line):
    return re.sub("[0-9]+", "0", " ".join(WORD.findall(line)).translate(LOWER))


def is_edit(a, b):
    """Whether two different lines begin and end alike for 70 % of the longer one."""
    a, b = a.split(" "), b.split(" ")

    def alike(x, y):
        return next((i for i, (u, v) in enumerate(zip(x, y, strict=False)) if u != v), min(len(x), len(y)))

    same = min(alike(a, b) + alike(a[::-1], b[::-1]), len(a), len(b))
    return 10 * same >= 7 * max(len(a), len(b))


def judged(rows, line_docs=10, depleted=70):
    """[(doc_id, kept, words in boilerplate lines)] of (doc_id, source, text)."""
    hosts = defaultdict(set)
    for _, source, text in rows:
        page = frozenset(n for x in (text or "").split("\n") if (n := normal(x)))
        hosts[source].add(page)
    boiler = set()
    for source, pages in hosts.items():
        count = Counter(line for page in pages for line in page)
        common = {line for line, n in count.items() if n >= line_docs}
        who = defaultdict(set)
        for page in pages:
            rare = page - common
            size = lambda lines: sum(len(x.split(" ")) for x in lines)
            edits = [r for r in rare if any(is_edit(r, c) for c in common - page)] if size(page & common) >= size(rare) else []
            same = ("all", page) if not rare else "near" if edits and 2 * size(edits) >= size(rare) else ("own", frozenset(rare))
            for line in page & common:
                who[line].add(same)
        boiler |= {(source, line) for line, same in who.items() if len(same) >= line_docs}
    out = []
    for doc_id, source, text in rows:
        lost = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if (source, normal(x)) in boiler)
        n, _, _, _, repeated = base(text)
        failed = n < 50 or 100 * repeated > 50 * n
        out.append((doc_id, not failed and 100 * lost <= depleted * n, lost))
    return sorted(out, key=str)


def text_of(rng, n):
    lines, left = [], n
    while left > 0:
        k = rng.randrange(4, 20)
        lines.append(" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(900)}x" for _ in range(k)))
        left -= k
    return "\n".join(lines)


def test_base_measures_and_awkward_rows(spark):
    df = documents(spark)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted(((r["doc_id"], *(r[n] for n in names), r["base_failed"]) for r in rows_of(quality.judge(df))), key=str)
    want = []
    for r in rows_of(pick(df, "doc_id", "text")):
        b = base(r["text"])
        want.append((r["doc_id"], *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
    assert got == sorted(want, key=str)


def test_lines_above_the_limits(spark):
    rng = random.Random(3)
    rows = [(i, "a", text_of(rng, 80)) for i in range(20)]
    notice = "Subscribe to our Letter no 17 today"
    rows += [(100 + i, "b", text_of(rng, 60) + f"\n{notice.upper() if i % 2 else notice.replace('17', str(i))}") for i in range(14)]
    rows += [(200 + i, "c", text_of(rng, 60) + f"\n{notice}") for i in range(9)]  # below the limit
    rows += [(300 + i, "b", "\n".join([text_of(rng, 8)] + [notice] * 12)) for i in range(3)]  # depleted
    article = text_of(rng, 120)
    rows += [(400 + i, "d", article) for i in range(30)]  # copies are no boilerplate
    for i in range(30):  # nor are near copies
        lines = article.split("\n")
        lines[rng.randrange(len(lines))] += f" new{i}"
        rows.append((500 + i, "e", "\n".join(lines)))
    rows += [(600, None, None), (601, "b", ""), (602, None, text_of(rng, 70))]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = sorted(((r["doc_id"], r["kept"], r["n_boiler_words"]) for r in rows_of(quality.judge(df))), key=str)
    assert got == judged(rows)
    kept = {d for d, k, _ in got if k}
    assert {*range(20), *range(100, 114), *range(200, 209), *range(400, 430), *range(500, 530), 602} == kept
    cleaned = {r["doc_id"]: r["text"] for r in rows_of(quality.keep(df))}
    assert set(cleaned) == kept
    assert not any("ubscribe" in cleaned[100 + i] or "SUBSCRIBE" in cleaned[100 + i] for i in range(14))
    assert all(cleaned[d] == t for d, s, t in rows if d in kept and s != "b")


def test_documents_of_shared_lines_are_depleted(spark):
    """Shared lines don't decide what is a copy: 90 % shared lines, and a line of its own each."""
    rng = random.Random(5)

    def line(n=12):
        return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(n))

    rows, depleted = [], set()
    for host, (many, own) in enumerate([(9, 1)] * 6 + [(8, 2), (12, 3)]):
        common = [line() for _ in range(many)]
        for i in range(40):
            rows.append((1000 * host + i, f"h{host}", "\n".join(common + [line() for _ in range(own)])))
            depleted.add(1000 * host + i)
    common = [line() for _ in range(20)]
    for i in range(40):  # nothing of their own
        rows.append((20_000 + i, "none", "\n".join(rng.sample(common, 12))))
        depleted.add(20_000 + i)
    article = [line() for _ in range(12)]
    for i in range(40):  # near copies with an edit each that nothing else has
        lines = [x.split() for x in article]
        rng.choice(lines)[rng.randrange(12)] = line(1)
        rows.append((30_000 + i, "copies", "\n".join(map(" ".join, lines))))
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = rows_of(quality.judge(df))
    assert not any(r["base_failed"] for r in got)
    assert {r["doc_id"] for r in got if not r["kept"]} == depleted
    assert {r["doc_id"] for r in rows_of(quality.keep(df))} == {r[0] for r in rows} - depleted


def plain_line(rng, n=12):
    return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(n))


def verdicts(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = sorted(((r["doc_id"], r["kept"], r["n_boiler_words"]) for r in rows_of(quality.judge(df))), key=str)
    assert found == judged(rows)
    return {d: (k, n) for d, k, n in found}


def test_copies_of_an_article_do_not_save_others_under_the_same_notice(spark):
    rng = random.Random(11)
    notice = [plain_line(rng) for _ in range(9)]
    rows = [(i, "h", "\n".join([*notice, plain_line(rng)])) for i in range(20)]
    article = [plain_line(rng) for _ in range(12)]
    for i in range(40):
        lines = [x.split() for x in article]
        rng.choice(lines)[rng.randrange(12)] = plain_line(rng, 1)
        rows.append((100 + i, "h", "\n".join([*notice, *map(" ".join, lines)])))
    found = verdicts(spark, rows)
    assert not any(found[i][0] for i in range(20)) and all(found[i][1] == 9 * 12 for i in range(20))
    assert all(found[100 + i][0] for i in range(40))


def test_a_common_opening_makes_no_edit(spark):
    rng = random.Random(12)
    shared = [plain_line(rng) for _ in range(8)]
    opening = "opening hours of our shop in"
    rows = [(i, "h", "\n".join([*shared, f"{opening} {plain_line(rng, 8)}"])) for i in range(40)]
    rows += [(100 + i, "h", f"{opening} the middle of town\n" + "\n".join(plain_line(rng) for _ in range(9))) for i in range(12)]
    found = verdicts(spark, rows)
    assert not any(found[i][0] for i in range(40))
    assert all(found[100 + i][0] for i in range(12))


def test_copies_that_differ_in_blanks_or_digits_are_one_document(spark):
    rng = random.Random(13)
    article = [plain_line(rng) for _ in range(9)]
    rows = [(i, "blanks", "\n".join([*article[:-1], article[-1] + " " * i])) for i in range(12)]
    rows += [(100 + i, "digits", "\n".join([*article, f"{plain_line(random.Random(1), 5)} page {i}"])) for i in range(12)]
    found = verdicts(spark, rows)
    assert all(kept and not lost for kept, lost in found.values())


def test_sql_says_the_same_of_shared_lines(spark, tmp_path):
    """The query's SQL on rows where copies, edits, notices and common openings meet."""
    rng = random.Random(14)
    rows = []
    for host in range(6):
        notice = [plain_line(rng, rng.choice([3, 12, 20])) for _ in range(rng.randrange(2, 10))]
        article = [plain_line(rng, rng.choice([4, 12, 30])) for _ in range(rng.randrange(4, 14))]
        for i in range(45):
            lines = [x.split() for x in article] if i % 2 else [plain_line(rng).split() for _ in range(rng.randrange(1, 12))]
            for _ in range(rng.randrange(0, 3)):
                line = rng.choice(lines)
                line[rng.randrange(len(line))] = rng.choice(["7", "88", plain_line(rng, 1)])
            rows.append((1000 * host + i, f"h{host}", "\n".join([*rng.sample(notice, rng.randrange(len(notice) + 1)), *map(" ".join, lines)])))
    verdicts(spark, rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(1)
    df.write.parquet(str(tmp_path / "documents"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_boiler_words"]
    assert difference(quality.judge(df).select(*names), db, sql.OP6) is None


def test_long_texts_repeat_words():
    words = [str(i) for i in range(3000)] * 2
    assert quality.repeat_words(words) == 6000
    assert quality.repeat_words(words[:3000]) == 0 and quality.repeat_words(["a", "b"]) == 0
    assert quality.repeat_words(["a"] * 4) == 4


def test_empty(spark):
    assert quality.judge(empty(spark)).count() == 0 and quality.keep(empty(spark)).count() == 0


def test_words_of_lines_are_stored_once(spark, monkeypatch):
    """What is stored by document and line has no words: they stay in the scan, and few documents need them again."""
    sizes, plain = {}, quality.stored

    def spied(df, label, *rest):
        table, folder = plain(df, label, *rest)
        sizes[label] = sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))
        return table, folder

    monkeypatch.setattr(quality, "stored", spied)
    words = [f"w{i * 7919 % 10007}" for i in range(4000)]
    texts = ["\n".join(" ".join(words[(37 * d + 200 * k + j) % 4000] for j in range(200)) for k in range(10)) for d in range(60)]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in enumerate(texts)], SCHEMA).coalesce(1)
    assert quality.judge(df).count() == 60
    assert sizes["quality-lines"] * 4 < sizes["quality-scan"]
