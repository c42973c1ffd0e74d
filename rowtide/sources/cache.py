"""Tables that are built once and reused."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has been committed."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def require_same(spark: SparkSession, path: str, fingerprint: str) -> None:
    """Note how ``path`` is made; raise if it was made in another way."""
    mark = f"{path.rstrip('/')}.fingerprint"
    if not finished(spark, mark):
        spark.range(1).select(F.lit(fingerprint).alias("fingerprint")).write.mode("overwrite").parquet(mark)
    elif (found := spark.read.parquet(mark).first()[0]) != fingerprint:
        raise ValueError(f"{path} was made in another way: {found} instead of {fingerprint}")


def cached_table(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], fingerprint: str | None = None
) -> DataFrame:
    """Read the table at ``path``; build and write it first if it is not there.

    ``fingerprint`` says what it is built from; a table of another one is refused.
    """
    if fingerprint is not None:
        require_same(spark, path, fingerprint)
    if not finished(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
