"""Conversation structure repair: generalised LR repair of the roles of each conversation (``glr``).

A conversation's rows, in the order of their turn (nulls first; rows of one turn by role, then by the md5 of their
text), become symbols: the role's initial, whether the row must go (it is blank, or role and text
were seen earlier), whether it is truncated. The cheapest edits that give roles ``(s?(ua)+)?`` are
found on the symbols alone; texts travel once, to be put together again.

* Equal rows of one turn are one row with a number before anything is ordered.
* The first of equal (role, text) is found by a minimum that is taken before the shuffle and joined back by row, so a text that
  fills a conversation is no hot group.
* A conversation of more than a chunk (``spark.rowtide.rowsPerChunk``) is cut. Each chunk is followed from every
  stack the rows before it can leave (there are four), and the chunks of a conversation are
  joined by the cheapest way through them.
* Rows of a conversation pass through a task one by one: what is held is one audit, which is
  part of the result. The digest of a conversation is a chain through all its text, so that one pass is
  in one task by definition.

Edge cases: a null role or text is one space, so the row has no legal role, or is blank; a role without
an initial (empty) is no legal role either. A null conv_id is a conversation of its own; rows with a null turn come
first. Turns whose span exceeds a long give null gaps. Repeated rows count singly, and all but the first are
duplicates. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import in_arrow, key_of, pick
from rowtide.llm.glr import TERMINALS, Repair, Run
from rowtide.operators.ordered import CHUNK, SPLIT, OrderedGroups
from rowtide.session import materialise

_BLANK = r"NOT text RLIKE r'[^\x20\x09-\x0D]'"
_WHOLE = r"text RLIKE r'[.!?][\x20\x09-\x0D]*\z'"
_CELL = ("key", "turn", "role", "digest")
_ORDER = ("turn IS NOT NULL", "turn", "role", "digest")
LINES = 1024  # output rows of a batch


def rows_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without nulls in role and text, and ``copies`` (1)."""
    df = pick(conversations, "conv_id", "turn", "role", "text")
    return df.selectExpr("conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text", "1 AS copies")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage that the checksum of conversation and turn names."""
    rows = rows_of(conversations).selectExpr(
        "*", "crc32(concat(coalesce(string(conv_id), ' '), ':', coalesce(string(turn), ' '))) % 20 AS fate"
    )
    return rows.filter("fate <> 0").selectExpr(
        "conv_id",
        "turn",
        "CASE WHEN fate = 4 THEN 'user' ELSE role END AS role",
        "CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END AS text",
        "CASE WHEN fate = 3 THEN 2 ELSE 1 END AS copies",
    )


def _cells(rows: DataFrame) -> DataFrame:
    """Different (conversation, turn, role, text) with their number and faults; texts stay behind."""
    light = rows.select(
        key_of("conv_id").alias("key"),
        "turn",
        "role",
        F.md5("text").alias("digest"),
        F.expr(_BLANK).alias("blank"),
        F.expr(f"NOT ({_WHOLE})").alias("cut"),
        F.col("copies").cast("long").alias("copies"),
    )
    cells = light.groupBy(*_CELL).agg(F.sum("copies").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    cells = materialise(cells, "conversation-cells")
    at = F.struct(F.col("turn").isNotNull().alias("later"), "turn")
    firsts = cells.groupBy("key", "role", "digest").agg(F.min(at)["turn"].alias("turn"))
    firsts = firsts.select(*[F.col(c).alias(f"f_{c}") for c in _CELL])
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in _CELL]
    return cells.join(firsts, same, "left").select(
        *_CELL, "n", "blank", "cut", F.col("f_key").isNotNull().alias("is_first"), F.substring("role", 1, 1).alias("initial")
    )


def _symbol(initial: str, cut: bool) -> str:
    """The grammar's symbol of a row that may stay; ``x`` is a role that must be changed."""
    shown = initial if initial in TERMINALS else "x"
    return shown.upper() if cut else shown


_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_PLAN = "key string, chunk int, entry int, leave int, cost bigint, audit string, illegal bigint, head string, tail string"


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and chunk: the cheapest ways through each chunk.

    A conversation in one chunk gives its whole repair (``leave`` -1), a part of one a row for each way.
    """
    repair, out = Repair(), []
    now, runs, illegal, head, tail, whole = None, [], 0, None, None, True

    def close() -> None:
        if now is None:
            return
        if whole:
            out.append((*now, 0, -1, *runs[0].finished(), illegal, head, tail))
        else:
            for entry, run in zip(repair.entries, runs, strict=True):
                out.extend((*now, entry, leave, *weight, illegal, head, tail) for leave, weight in run.exits().items())

    def sent() -> pa.RecordBatch:
        names = [c.split()[0] for c in _PLAN.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        for key, chunk, split, initial, n, blank, cut, is_first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now != (key, chunk):
                close()
                if len(out) >= LINES:
                    yield sent()
                now, illegal, head, tail, whole = (key, chunk), 0, initial, None, not split
                runs = [Run(repair, e) for e in (repair.entries if split else (0,))]
            stays = is_first and not blank
            for run in runs:
                if stays:
                    run.feed(_symbol(initial, cut))
                for _ in range(n - stays):
                    run.feed("-")
            illegal += n - 1 + (tail is not None and (tail, initial) not in _LEGAL)
            tail = initial
    close()
    if out:
        yield sent()


def _joined(ways: pa.Table) -> pa.Table:
    """The chunks of one conversation as one repair."""
    repair, chunks = Repair(), {}
    for row in ways.to_pylist():
        chunks.setdefault(row["chunk"], []).append(row)
    live, illegal, tail = {0: (0, "")}, 0, None
    for _, rows in sorted(chunks.items()):
        out = {}
        for r in rows:
            if r["entry"] in live:
                cost, audit = live[r["entry"]]
                weight = (cost + r["cost"], audit + r["audit"])
                out[r["leave"]] = min(out.get(r["leave"], weight), weight)
        live = out
        illegal += rows[0]["illegal"] + (tail is not None and (tail, rows[0]["head"]) not in _LEGAL)
        tail = rows[0]["tail"]
    cost, audit = repair.finished(tuple((n, c, a) for n, (c, a) in live.items()))
    return pa.table(
        {"key": [ways["key"][0].as_py()], "cost": pa.array([cost], pa.int64()), "audit": [audit], "illegal": pa.array([illegal], pa.int64())}
    )


def plans(cells: DataFrame) -> DataFrame:
    """key, cost, audit, illegal for each conversation that has rows."""
    groups = OrderedGroups(cells, ["key"], [F.expr(e) for e in _ORDER], derived=True)
    df = groups.df if groups.is_split else groups.df.withColumns({CHUNK: F.lit(0), SPLIT: F.lit(False)})
    ordered = df.repartition("key", CHUNK).sortWithinPartitions("key", CHUNK, *[F.expr(e) for e in _ORDER])
    ways = in_arrow(ordered.select("key", CHUNK, SPLIT, "initial", "n", "blank", "cut", "is_first"), _followed, _PLAN)
    if not groups.is_split:
        return ways.select("key", "cost", "audit", "illegal")
    ways = materialise(ways, "conversation-ways")
    parts = ways.filter("leave >= 0").groupBy("key").applyInArrow(_joined, "key string, cost bigint, audit string, illegal bigint")
    return ways.filter("leave < 0").select("key", "cost", "audit", "illegal").unionByName(parts)


def _sorted_texts(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, in one partition."""
    texts = rows.select(
        key_of("conv_id").alias("key"), F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("digest"), "text", "copies", F.lit(None).cast("string").alias("audit")
    )
    turn = rows.schema["turn"].dataType
    none = F.lit(None).cast("string")
    heads = planned.select(
        "key", F.lit(0).alias("kind"), F.lit(None).cast(turn).alias("turn"), none.alias("role"), none.alias("digest"), none.alias("text"), F.lit(0).alias("copies"), "audit"
    )
    both = texts.unionByName(heads).repartition("key")
    return both.sortWithinPartitions("key", "kind", *[F.expr(e) for e in _ORDER]).select("key", "audit", "role", "text", "copies")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None, str | None]]:
    """(key, role, text) of the repaired rows; (key, None, None) once a conversation is over."""
    key, audit, at, count = None, "", 0, 0

    def inserted() -> Iterator[tuple[str, str, str]]:
        nonlocal at, count
        while at < len(audit) and audit[at] == "I":
            yield key, ("user", "assistant")[count % 2], ""
            at, count = at + 1, count + 1

    for batch in batches:
        for k, head, role, text, copies in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if head is not None:
                if key is not None:
                    yield from inserted()
                    yield key, None, None
                key, audit, at, count = k, head, 0, 0
            for _ in range(copies):
                yield from inserted()
                letter = audit[at]
                at += 1
                if letter == "K":
                    yield key, role, text
                    count += role[:1] != "s"
                elif letter == "R":
                    yield key, ("user", "assistant")[count % 2], text
                    count += 1
    if key is not None:
        yield from inserted()
        yield key, None, None


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, chain, first = [], hashlib.sha256(), True

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"key": [k for k, _ in out], "repaired_sha256": [d for _, d in out]})

    for key, role, text in _edited(batches):
        if role is None:
            out.append((key, chain.hexdigest()))
            chain, first = hashlib.sha256(), True
            if len(out) >= LINES:
                yield sent()
                out = []
        else:
            chain.update(("" if first else "\n").encode() + role.encode() + b":" + text.encode())
            first = False
    if out:
        yield sent()


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, place, size = [], 0, 0

    def sent() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "place", "role", "text"])

    for key, role, text in _edited(batches):
        if role is None:
            place = 0
            continue
        out.append((key, place, role, text))
        place, size = place + 1, size + len(text)
        if len(out) >= LINES or size > 1 << 22:
            yield sent()
            out, size = [], 0
    if out:
        yield sent()


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations, a row for each turn: conv_id, place (from 0), role, text.

    ``rows`` as from ``rows_of``.
    """
    rows = materialise(rows, "conversation-rows")
    turns = in_arrow(_sorted_texts(rows, plans(_cells(rows))), _written, "key string, place bigint, role string, text string")
    kind = rows.schema["conv_id"].dataType
    return turns.select(F.when(F.col("key") != "null", F.expr("substr(key, 2)")).cast(kind).alias("conv_id"), "place", "role", "text")


def judged(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``, by the repair of ``rows``: faults, cost, audit, digest."""
    rows = materialise(rows, "conversation-rows")
    cells = materialise(_cells(rows), "conversation-faults")
    wide = "decimal(38,0)"
    span = F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count_distinct("turn").cast(wide)
    stays = F.col("is_first").cast("long")
    faults = cells.groupBy("key").agg(
        F.coalesce(span, F.lit(0)).try_cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - stays)).alias("duplicate"),
        F.sum(F.when(F.col("cut") & ~F.col("blank"), stays).otherwise(0)).alias("truncated"),
    )
    planned = materialise(plans(cells), "conversation-plans")
    digests = in_arrow(_sorted_texts(rows, planned), _digested, "key string, repaired_sha256 string")
    every = pick(conversations, "conv_id").groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", key_of("conv_id").alias("key"))
    zero = F.lit(0).cast("long")
    counts = [
        F.when(F.col("audit").isNull(), zero).otherwise(F.col(c)).alias(c)
        for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ]
    return (
        every.join(faults, "key", "left")
        .join(planned, "key", "left")
        .join(digests, "key", "left")
        .select(
            "conv_id",
            *counts,
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )
