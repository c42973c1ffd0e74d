"""Session settings: shared work folder, sizes that bound chunks and broadcasts.

All sizes are plain session settings, so a job can change them without code:

``spark.rowtide.rowsPerChunk``   rows of one group that a single task may sort
``spark.rowtide.cellsPerChunk``  the same bound as rows x columns, for wide rows
``spark.rowtide.maxChunks``      upper bound on the chunks of all split groups together
``spark.rowtide.broadcastRows``  largest table (in rows) that is broadcast
``spark.rowtide.broadcastBytes`` the same bound as bytes, by the width of its columns
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_PRIVATE_DIR = "spark.rowtide.workDir"


@dataclass(frozen=True)
class Limits:
    rows_per_chunk: int
    cells_per_chunk: int
    max_chunks: int
    broadcast_rows: int
    broadcast_bytes: int

    def may_broadcast(self, rows: int, schema: T.StructType) -> bool:
        """Whether a table of so many rows is within both bounds; text counts as 64 bytes."""
        width = sum(64 if isinstance(f.dataType, (T.StringType, T.BinaryType)) else 8 for f in schema.fields)
        return rows <= self.broadcast_rows and rows * width <= self.broadcast_bytes


def limits(spark: SparkSession) -> Limits:
    get = spark.conf.get
    return Limits(
        int(get("spark.rowtide.rowsPerChunk", "1000000")),
        int(get("spark.rowtide.cellsPerChunk", "64000000")),
        int(get("spark.rowtide.maxChunks", "50000")),
        int(get("spark.rowtide.broadcastRows", "200000")),
        int(get("spark.rowtide.broadcastBytes", "33554432")),
    )


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever used in local mode, where driver and
    executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    # "local[8]" is one process; "local-cluster[...]" is not.
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    named = spark.conf.get(_PRIVATE_DIR, None)
    if not named:
        named = tempfile.mkdtemp(prefix="rowtide-")
        spark.conf.set(_PRIVATE_DIR, named)
    return named


def ship(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once; needed before any Python function runs there."""
    context = spark.sparkContext
    if getattr(context, "_rowtide_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="rowtide-")) / "rowtide-package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._rowtide_shipped = True


_made: dict[str, list[str]] = {}


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clean_up(spark: SparkSession) -> int:
    """Remove every table that this session stored; call it once results have been written elsewhere."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        discard(spark, path)
    return len(paths)


def stored(df: DataFrame, label: str, compression: str = "snappy") -> tuple[DataFrame, str]:
    """Write once to the shared folder; the table as read back, and its folder for ``discard``."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    return stored(df, label)[0]


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps that are over; it does so when the driver collects garbage.

    The first collection ends what still holds the last step's plan, the second one frees its shuffles.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()


_HUGE = "spark.sql.codegen.hugeMethodLimit"
_COMPILED = 8000  # bytes of a generated method that the JVM still compiles; a larger one is interpreted for good


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves whole-stage code where that is one method too large for the JVM's compiler.

    Spark then projects such rows in small methods, which are compiled.
    """
    before = spark.conf.get(_HUGE, None)
    spark.conf.set(_HUGE, str(min(_COMPILED, int(before or _COMPILED))))
    try:
        yield
    finally:
        spark.conf.unset(_HUGE) if before is None else spark.conf.set(_HUGE, before)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a stored table that nothing will read again."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Iterative trainers cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark))
