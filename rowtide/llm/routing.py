"""Routes: sets that share a hashed key meet under one leader, whatever the number of sets on a key.

Rows have a ``node`` (a 64-bit name) and ``routes`` (keys, ``KEY_BYTES`` each, end to
end). The least node on a key leads it, in whatever order nodes arrive, so a task that
is repeated gives the same pairs. A bucket's memory grows with its different keys, not
with the nodes on one key: what exceeds a chunk waits in a file of the task until all
leaders are known.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import in_arrow

KEY_BYTES = 6  # of a key's hash; a false meeting costs a comparison, no more
PER_BUCKET = 500_000
_BLOB = 250_000


def packed(keys: np.ndarray, owners: np.ndarray, n: int) -> list[bytes]:
    """The keys of each of ``n`` owners, as bytes."""
    order = np.argsort(owners, kind="stable")
    raw = np.ascontiguousarray(keys[order].view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES])
    cuts = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=n))]).tolist()
    return [raw[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, KEY_BYTES)
    return wide.reshape(-1).view("<u8")


def buckets_for(rows: DataFrame) -> int:
    total = rows.agg(F.sum(F.length("routes"))).first()[0] or 0
    return max(16, -(-total // KEY_BYTES // PER_BUCKET))


def _blobs(key: np.ndarray, node: np.ndarray, buckets: int) -> pa.RecordBatch:
    # High bits pick the bucket, low bits tell keys apart inside it.
    bucket = ((key >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    bucket, low, node = bucket[order], key[order].astype("<u4"), node[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + np.uint64(1)))
    pairs = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[cuts].astype(np.int64)),
            pa.array([low[a:b].tobytes() for a, b in pairs], pa.binary()),
            pa.array([node[a:b].tobytes() for a, b in pairs], pa.binary()),
        ],
        names=["bucket", "keys", "nodes"],
    )


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Routes by bucket, many to a row; a node that repeats in a task is sent once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        keys: list[bytes] = []
        nodes: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for node, own in zip(batch.column("node").to_pylist(), batch.column("routes").to_pylist(), strict=True):
                if not own or node in sent:
                    continue
                sent.add(node)
                keys.append(own)
                nodes.append(np.full(len(own) // KEY_BYTES, node, "<i8"))
                held += len(nodes[-1])
                if held >= _BLOB:
                    yield _blobs(unpacked(b"".join(keys)), np.concatenate(nodes), buckets)
                    keys, nodes, held = [], [], 0
        if held:
            yield _blobs(unpacked(b"".join(keys)), np.concatenate(nodes), buckets)

    return in_arrow(rows.select("node", "routes"), run, "bucket bigint, keys binary, nodes binary")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys with their bucket in the high half, nodes), a bounded number at a time."""
    keys, nodes, held = [], [], 0
    for batch in batches:
        for bucket, key, node in zip(*[batch.column(c).to_pylist() for c in ("bucket", "keys", "nodes")], strict=True):
            keys.append((np.uint64(bucket) << np.uint64(32)) | np.frombuffer(key, "<u4"))
            nodes.append(np.frombuffer(node, "<i8"))
            held += len(keys[-1])
            if held >= PER_BUCKET:
                yield np.concatenate(keys), np.concatenate(nodes)
                keys, nodes, held = [], [], 0
    if held:
        yield np.concatenate(keys), np.concatenate(nodes)


def _starts(key: np.ndarray) -> np.ndarray:
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.flatnonzero(new)


def _led(
    key: np.ndarray, node: np.ndarray, known: np.ndarray, leads: np.ndarray, with_keys: bool
) -> Iterator[pa.RecordBatch]:
    """The pairs of a chunk that is sorted by key."""
    starts = _starts(key)
    lead = leads[np.searchsorted(known, key[starts])]
    leader = np.repeat(lead, np.diff(np.append(starts, len(key))))
    met = leader != node
    columns = [leader[met], node[met]]
    if with_keys:
        low = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # A leader is told once per chunk that has others on its key.
        led_runs = np.add.reduceat(met.astype(np.int64), starts) > 0
        own = [lead[led_runs], lead[led_runs], low[starts][led_runs]]
        columns = [np.concatenate(c) for c in zip([*columns, low[met]], own, strict=True)]
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    if len(order):
        yield pa.RecordBatch.from_arrays([pa.array(c[new]) for c in columns], names=["leader", "node", "low"][: len(columns)])


def led(rows: DataFrame, buckets: int, with_keys: bool = False) -> DataFrame:
    """Distinct (leader, node) for every node that shares a key with its leader.

    ``with_keys``: distinct (leader, node, low), ``low`` being the low half of the key,
    and the leaders themselves as nodes too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, leads = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        last, waiting = None, 0
        with tempfile.TemporaryFile() as file:
            for key, node in _gathered(batches):
                if last is not None:
                    for part in last:
                        np.save(file, part)
                    waiting += 1
                order = np.argsort(key, kind="stable")
                last = key[order], node[order]
                starts = _starts(last[0])
                # The least node: texts that share much then share most of their leaders.
                heads, lead = last[0][starts], np.minimum.reduceat(last[1], starts)
                old = np.zeros(len(heads), bool)
                if len(known):
                    at = np.minimum(np.searchsorted(known, heads), len(known) - 1)
                    old = known[at] == heads
                    leads[at[old]] = np.minimum(leads[at[old]], lead[old])
                merged = np.concatenate([known, heads[~old]])
                place = np.argsort(merged, kind="stable")
                known, leads = merged[place], np.concatenate([leads, lead[~old]])[place]
            if last is not None:
                yield from _led(*last, known, leads, with_keys)
            file.seek(0)
            for _ in range(waiting):
                yield from _led(np.load(file), np.load(file), known, leads, with_keys)

    schema = "leader bigint, node bigint" + (", low bigint" if with_keys else "")
    return in_arrow(_dealt(rows, buckets).repartition(buckets, "bucket"), run, schema).distinct()
