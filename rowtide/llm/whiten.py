"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers x = floor(1024 c) + 100000. Their covariance V is never formed: one pass
over the data gives V Q for a narrow block Q, each task adding Xᵀ(X Q) of its rows after
taking the mean off, exactly (the whole part as integers, the rest as one fraction). A round of the iteration is

1. a Chebyshev polynomial of V, by its recurrence, one pass a degree; it is small on the
   part of the spectrum below the block's least Ritz value and grows fast above it;
2. QR, one more pass, and Rayleigh-Ritz: the Ritz values, and the residual of each pair.

Rounds go on until the wanted pairs are certified: their residuals, which bound the distance to an
eigenvalue and, over the gap to the next one, that to its vector, are down to rounding. That is so when they are
below ``close`` of the largest eigenvalue and another round does not halve them.

What is broadcast or comes to the driver is one block of (dimensions x ``width``) doubles.
Sums of tasks are added in the order of their number, in slices of the dimensions, so reruns give the same
doubles.

Edge cases: vectors that are null or hold null or non-finite entries are dropped, and so are
those with an entry beyond 2**42 in size, and those of another length than most (of equally frequent lengths, the longest
stays). Rows with a null or repeated vec_id are vectors of their own. Components without variance (fewer vectors or
dimensions than components, or repeated vectors only) are left out, as nothing can be scaled to one along them: a table of equal vectors, one
vector, or none gives an empty result. Of equal eigenvalues any basis is taken, the same for all rows. A
deviation of more than 38 digits is null. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import in_arrow, pick
from rowtide.session import ship, stored

SCALE, SHIFT = 1024.0, 100_000
LARGEST = float(1 << 42)
ENTRIES = 1 << 21  # of vectors, that a task works on at a time
SLICE = 256  # dimensions whose sums are added in one task
EMPTY = 1e-11  # of the whole variance: what rounding leaves


@dataclass(frozen=True)
class Settings:
    components: int = 8
    spare: int = 24  # further columns of the block
    degree: int = 10
    rounds: int = 60  # at most
    close: float = 1e-9
    seed: int = 7


@dataclass(frozen=True)
class Prepared:
    """Stored vectors (``vec_id``, ``x``: whole numbers of 64 bits), how many, and the exact sums of each dimension."""

    table: DataFrame
    n: int
    sums: list[int]

    @property
    def whole(self) -> np.ndarray:
        """The whole part of the mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """Sum less whole part times number: below ``n``."""
        return np.array([s % self.n for s in self.sums], np.int64)


@dataclass(frozen=True)
class Whitening:
    vectors: np.ndarray  # a column for each component
    values: np.ndarray
    trace: float
    residuals: np.ndarray  # over the largest eigenvalue
    rounds: int


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.int64).reshape(len(column), width)


def _parts(source: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, ENTRIES // width)
    for batch in source:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def prepare(embeddings: DataFrame) -> Prepared:
    """Usable vectors as whole numbers, stored, with their exact sums."""
    spark = embeddings.sparkSession
    df = pick(embeddings, "vec_id", "embedding").withColumn("c", F.col("embedding").cast("array<double>"))
    good = df.filter(f"c IS NOT NULL AND NOT exists(c, e -> e IS NULL OR isnan(e) OR abs(e) >= {LARGEST / SCALE!r}D)")
    common = good.groupBy(F.size("c").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = common["width"] if common else 0
    kind = embeddings.schema["vec_id"].dataType.simpleString() if "vec_id" in embeddings.columns else "bigint"
    if not width:
        return Prepared(spark.createDataFrame([], f"vec_id {kind}, x binary"), 0, [])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(source, width):
            c = batch.column("c").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            x = np.floor(SCALE * c).astype(np.int64) + SHIFT
            raw = pa.Array.from_buffers(
                pa.binary(), len(x), [None, pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * (8 * width)), pa.py_buffer(x.tobytes())]
            )
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), raw], ["vec_id", "x"])

    table, _ = stored(in_arrow(good.filter(F.size("c") == width).select("vec_id", "c"), run, f"vec_id {kind}, x binary"), "vectors")

    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in _parts(source, width):
            x = _matrix(batch.column("x"), width)
            n += len(x)
            high += (x >> 24).sum(axis=0)
            low += (x & 0xFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"dimension": np.arange(width), "n": np.full(width, n), "high": high, "low": low})

    sums = (
        in_arrow(table.select("x"), add, "dimension bigint, n bigint, high bigint, low bigint")
        .groupBy("dimension")
        .agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
        .orderBy("dimension")
        .collect()
    )
    return Prepared(table, sums[0]["n"], [(r["high"] << 24) + r["low"] for r in sums])


def _added(group: pa.Table) -> pa.Table:
    """The sum of one slice's blocks, in the order of the tasks."""
    ordered = group.sort_by("part")
    total = None
    for raw in ordered["block"]:
        block = np.frombuffer(raw.as_py(), np.float64)
        total = block.copy() if total is None else total + block
    return pa.table({"slice": group["slice"].slice(0, 1), "block": pa.array([total.tobytes()], pa.binary())})


class Covariance:
    """Passes over prepared vectors."""

    def __init__(self, data: Prepared) -> None:
        self.data, self.width = data, len(data.sums)
        ship(data.table.sparkSession)

    def centred(self) -> Callable[[pa.RecordBatch], np.ndarray]:
        whole, fraction, width = self.data.whole, self.data.rest / self.data.n, self.width
        return lambda batch: (_matrix(batch.column("x"), width) - whole) - fraction

    def times(self, block: np.ndarray) -> np.ndarray:
        """V times a block, and in one further column the variance of each dimension."""
        spark, width, centred = self.data.table.sparkSession, self.width, self.centred()
        sent = spark.sparkContext.broadcast(block)

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = sent.value
            total = np.zeros((width, q.shape[1] + 1))
            for batch in _parts(source, width):
                x = centred(batch)
                total[:, :-1] += x.T @ (x @ q)
                total[:, -1] += (x * x).sum(axis=0)
            cuts = list(range(0, width, SLICE))
            yield pa.RecordBatch.from_pydict(
                {
                    "slice": pa.array(cuts, pa.int64()),
                    "part": pa.array([TaskContext.get().partitionId()] * len(cuts), pa.int64()),
                    "block": pa.array([total[c : c + SLICE].tobytes() for c in cuts], pa.binary()),
                }
            )

        parts = in_arrow(self.data.table.select("x"), run, "slice bigint, part bigint, block binary")
        rows = parts.groupBy("slice").applyInArrow(_added, "slice bigint, block binary").collect()
        sent.unpersist()
        out = [np.frombuffer(bytes(r["block"])).reshape(-1, block.shape[1] + 1) for r in sorted(rows, key=lambda r: r["slice"])]
        return np.concatenate(out) / self.data.n

    def identity_error(self, found: Whitening) -> float:
        """Largest absolute entry of the whitened vectors' covariance less the identity."""
        width, centred, to = self.width, self.centred(), found.vectors / np.sqrt(found.values)
        k = to.shape[1]

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            state = (0, np.zeros(k), np.zeros((k, k)))
            for batch in _parts(source, width):
                w = centred(batch) @ to
                mean = w.mean(axis=0)
                state = _merged(state, (len(w), mean, (w - mean).T @ (w - mean)))
            block = np.concatenate([[state[0]], state[1], state[2].ravel()])
            yield pa.RecordBatch.from_pydict(
                {"slice": [0], "part": [TaskContext.get().partitionId()], "block": pa.array([block.tobytes()], pa.binary())}
            )

        def merge(group: pa.Table) -> pa.Table:
            state = (0, np.zeros(k), np.zeros((k, k)))
            for raw in group.sort_by("part")["block"]:
                b = np.frombuffer(raw.as_py(), np.float64)
                state = _merged(state, (int(b[0]), b[1 : k + 1], b[k + 1 :].reshape(k, k)))
            return pa.table({"error": [float(np.abs(state[2] / state[0] - np.eye(k)).max())]})

        parts = in_arrow(self.data.table.select("x"), run, "slice bigint, part bigint, block binary")
        return parts.groupBy("slice").applyInArrow(merge, "error double").first()["error"]


def _merged(a: tuple, b: tuple) -> tuple:
    """(number, mean, sum of centred products) of two sets together."""
    if not a[0] or not b[0]:
        return a if a[0] else b
    n, off = a[0] + b[0], b[1] - a[1]
    return n, a[1] + off * (b[0] / n), a[2] + b[2] + np.outer(off, off) * (a[0] * b[0] / n)


def _filtered(times: Callable, q: np.ndarray, vq: np.ndarray, top: float, cut: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of V, applied to q: within one on [0, cut], scaled to one at ``top``; vq is V q."""
    half = cut / 2
    first = half / (top - half)
    sigma = first
    before, now = q, (vq - half * q) * (sigma / half)
    for _ in range(1, degree):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now)[:, :-1] - half * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def components(data: Prepared, settings: Settings = Settings()) -> Whitening:
    """The leading eigenpairs of the covariance that have any variance, by falling eigenvalue."""
    cov = Covariance(data)
    width, wanted = cov.width, min(settings.components, cov.width)
    size = min(width, wanted + settings.spare)
    q = np.linalg.qr(np.random.default_rng(settings.seed).standard_normal((width, size)))[0]
    last, done = np.inf, 0
    for done in range(1, settings.rounds + 1):
        product = cov.times(q)
        trace = float(product[:, -1].sum())
        if trace <= 0:
            return Whitening(np.zeros((width, 0)), np.zeros(0), 0.0, np.zeros(0), done)
        vq = product[:, :-1]
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residuals = np.linalg.norm(vq - q * values, axis=0)[:wanted] / values[0]
        worst = float(residuals.max())
        # At rounding another round no longer helps; a block as wide as the space has it at once.
        if worst <= settings.close and (size == width or worst > last / 2):
            break
        last = worst
        cut = max(values[-1], values[0] * 1e-6)
        if size < width and cut < values[0]:
            q = np.linalg.qr(_filtered(cov.times, q, vq, values[0], cut, settings.degree))[0]
        else:
            q = np.linalg.qr(q)[0]
    else:
        raise RuntimeError(f"not certified after {settings.rounds} rounds: residual {worst:.3g}; raise spare or degree")
    keep = [i for i in range(wanted) if values[i] > EMPTY * trace]
    return Whitening(q[:, keep], values[keep], trace, residuals[keep], done)


def _deviations(y: np.ndarray, rest: np.ndarray, n: int) -> list[Decimal | None]:
    """Exact sum over dimensions of (n y - rest)²."""
    most = int(np.abs(y).max(initial=0))
    if (n * (most + 1)) ** 2 * y.shape[1] < 1 << 63:
        sums = ((n * y - rest) ** 2).sum(axis=1).tolist()
    elif most < 1 << 24 and y.shape[1] < 1 << 14 and n < 1 << 48:
        # n² Σy² - 2 n Σ y rest + Σ rest², the middle one by halves of rest
        squares = (y * y).sum(axis=1).tolist()
        low, high = (y @ (rest & 0xFFFFFF)).tolist(), (y @ (rest >> 24)).tolist()
        last = sum(r * r for r in rest.tolist())
        sums = [n * n * s - 2 * n * ((h << 24) + w) + last for s, h, w in zip(squares, high, low, strict=True)]
    else:
        ends = rest.tolist()
        sums = [sum((n * v - r) ** 2 for v, r in zip(row, ends, strict=True)) for row in y.tolist()]
    return [Decimal(s) if s < 10**38 else None for s in sums]


def whitened(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    data = prepare(embeddings)
    kind = data.table.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    none = embeddings.sparkSession.createDataFrame([], schema)
    if not data.n:
        return none
    found = components(data, settings)
    k = len(found.values)
    if not k:
        return none
    cov = Covariance(data)
    error, width, centred = cov.identity_error(found), cov.width, cov.centred()
    to, shares, n, whole, rest = found.vectors / np.sqrt(found.values), found.values / found.trace, data.n, data.whole, data.rest

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(source, width):
            m = batch.num_rows
            far = pa.array(_deviations(_matrix(batch.column("x"), width) - whole, rest, n), pa.decimal128(38, 0))
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    far.take(each),
                    pa.array((centred(batch) @ to).ravel()),
                    pa.array(np.tile(shares, m)),
                    pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return in_arrow(data.table, run, schema)
