"""Secret scans with corpus-wide ownership frequency.

One pass finds candidates in every whole text: the base kinds (assign, access, hex),
which are always reported, and further kinds whose patterns also match documentation
samples (private key blocks, web tokens, vendor keys, bearer tokens, passwords in
addresses). The hashes of all candidate values are counted over the corpus, by
distinct repositories (documents) and distinct owners (sources). A value that more
than ``max_owners`` owners have is a widely copied example; a value below that looks
live and belongs to somebody. A further kind is reported only where its value looks
live.

Results are text positions in code points, end exclusive. Spans of different kinds
may overlap; spans of one kind do not.

Edge cases: a null text is empty and has no spans; a null source is an owner of its
own; rows that repeat are each reported, and count once for ownership; a text without
candidates has no spans and the hash of the empty string.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import by_batch, key_of, pick, texts, whole_rows, with_texts
from rowtide.session import materialise

# The base kinds with their patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = ("assign", "access", "hex")
# Further kinds; the last group is the secret itself.
FURTHER = {
    "pem": ("-----BEGIN", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----([^-]{16,})(?:-----END [A-Z ]*PRIVATE KEY-----)?")),
    "jwt": ("eyJ", re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})")),
    "vendor": (
        "_",
        re.compile(r"\b((?:gh[pousr]|github_pat|glpat|npm|sk_live|rk_live)[_-][A-Za-z0-9_-]{16,})"),
    ),
    "slack": ("xox", re.compile(r"\b(xox[abprs]-[A-Za-z0-9-]{16,})")),
    "google": ("AIza", re.compile(r"\b(AIza[A-Za-z0-9_-]{30,})")),
    "bearer": ("earer ", re.compile(r"\b[Bb]earer\x20+([A-Za-z0-9._~+/-]{20,}=*)")),
    "address": ("://", re.compile(r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:([^\s/@]{6,128})@")),
}
KINDS = (*BASE, *FURTHER)
_PLACE = {kind: i for i, kind in enumerate(KINDS)}

_SCAN = (
    "doc_id bigint, owner string, row_key bigint, n_assign bigint, n_access bigint, n_hex bigint, "
    "base_sha256 string, found array<struct<start:bigint, place:int, end:bigint, value:bigint>>"
)
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("place", pa.int32()), ("end", pa.int64()), ("value", pa.int64())]))


def _signed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, place of the kind, end, secret value) of all candidates, by start and kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    for kind, (hint, pattern) in FURTHER.items():
        if hint in text:
            found += [(m.start(), _PLACE[kind], m.end(), m[1]) for m in pattern.finditer(text)]
    return sorted(found)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[place]}:{start}:{end}" for start, place, end in spans)


def _scan(batch: pa.RecordBatch) -> pa.RecordBatch:
    cols = {name: [] for name in ("row_key", "n_assign", "n_access", "n_hex", "base_sha256", "found")}
    ids, owners = batch.column("doc_id").to_pylist(), batch.column("owner").to_pylist()
    for doc_id, owner, text in zip(ids, owners, texts(batch), strict=True):
        found = candidates(text)
        base = [(s, p, e) for s, p, e, _ in found if p < len(BASE)]
        for place, name in enumerate(("n_assign", "n_access", "n_hex")):
            cols[name].append(sum(p == place for _, p, _ in base))
        cols["row_key"].append(_signed(f"{doc_id}|{owner}|{text}") if found else 0)
        cols["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
        cols["found"].append([{"start": s, "place": p, "end": e, "value": _signed(v)} for s, p, e, v in found])
    data = [batch.column("doc_id"), batch.column("owner")]
    data += [pa.array(v, _FOUND if k == "found" else pa.string() if k == "base_sha256" else pa.int64()) for k, v in cols.items()]
    return pa.RecordBatch.from_arrays(data, names=["doc_id", "owner", *cols])


def scan(docs: DataFrame) -> DataFrame:
    """Candidates and base results of each document."""
    owned = pick(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), key_of("source").alias("owner"), "text"
    )
    return by_batch(owned, _scan, _SCAN)


def ownership(scanned: DataFrame) -> DataFrame:
    """Of each candidate value: distinct repositories (documents) and distinct owners.

    Counted in two steps, so that a value that a third of the corpus has is combined
    before each shuffle.
    """
    uses = scanned.select("doc_id", "owner", F.explode("found.value").alias("value"))
    per_repo = uses.groupBy("value", "owner", "doc_id").agg(F.lit(1).alias("one"))
    per_owner = per_repo.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    return per_owner.groupBy("value").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def find(docs: DataFrame, max_owners: int = 3) -> DataFrame:
    """doc_id, base counts and hash, ``found`` (all reported spans) and ``n_live``, ``n_examples`` candidates.

    ``found`` is an array of (start, place, end), place being the index in ``KINDS``.
    """
    scanned = materialise(scan(docs), "secrets-scan")
    with_any = scanned.filter(F.size("found") > 0)
    owners = ownership(with_any).select("value", (F.col("n_owners") <= max_owners).alias("live"))
    one = F.explode("found").alias("c")
    judged = (
        with_any.select("row_key", one)
        .select("row_key", "c.start", "c.place", "c.end", "c.value")
        .distinct()
        .join(owners, "value")
    )
    reported = F.when((F.col("place") < len(BASE)) | F.col("live"), F.struct("start", "place", "end"))
    per_row = judged.groupBy("row_key").agg(
        F.array_sort(F.collect_list(reported)).alias("kept"),
        F.sum(F.col("live").cast("long")).alias("live"),
        F.count("*").alias("all"),
    )
    none = F.expr("CAST(array() AS array<struct<start:bigint, place:int, end:bigint>>)")
    zero = F.lit(0).cast("long")
    hits = with_any.join(per_row, "row_key").select(
        *[c for c in scanned.columns if c not in ("found", "row_key")],
        F.col("kept").alias("found"),
        F.col("live").alias("n_live"),
        (F.col("all") - F.col("live")).alias("n_examples"),
    )
    misses = scanned.filter(F.size("found") == 0).select(
        *[c for c in scanned.columns if c not in ("found", "row_key")],
        none.alias("found"),
        zero.alias("n_live"),
        zero.alias("n_examples"),
    )
    return hits.unionByName(misses)


def spans(found: str = "found"):
    """The spans as text: kind:start:end by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.col(found),
            lambda s: F.concat_ws(":", F.element_at(names, s["place"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _redacted(text: str | None, live: list[int] | None) -> str | None:
    end, parts = 0, []
    for start, place, stop, value in candidates(text or ""):
        if place < len(BASE) or _signed(value) in (live or ()):
            if start >= end:
                parts += [text[end:start], f"[{KINDS[place]}]"]
            end = max(end, stop)
    return "".join(parts) + text[end:] if parts else text


def redact(docs: DataFrame, max_owners: int = 3) -> DataFrame:
    """All documents and columns, with each reported span replaced by its kind in brackets.

    The base kinds follow from a text alone. Of the further kinds a text needs the
    values that look live; they are joined to it by doc_id. n_chars follows the text.
    Further columns may have any name.
    """
    found = scan(docs).select("doc_id", "owner", "row_key", "found").filter(F.size("found") > 0)
    found = materialise(found, "secrets-scan")
    live = ownership(found).filter(F.col("n_owners") <= max_owners).select("value")
    further = found.select("doc_id", F.explode("found").alias("c")).filter(F.col("c.place") >= len(BASE))
    per_doc = (
        further.select("doc_id", F.col("c.value").alias("value"))
        .join(live, "value")
        .groupBy(F.col("doc_id").alias("doc"))
        .agg(F.collect_set("value").alias("live"))
    )
    rows = whole_rows(docs, "doc_id")
    joined = rows.join(per_doc, F.col("doc_id").cast("long").eqNullSafe(F.col("doc")), "left").select("row", "live")
    return with_texts(joined, docs, "live", _redacted)
