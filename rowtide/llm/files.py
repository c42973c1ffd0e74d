"""Files that tasks write to and read from the shared folder, by the file system that its address names."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from rowtide.session import new_path


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the shared one, as a full address that tasks can open."""
    path = spark._jvm.org.apache.hadoop.fs.Path(new_path(spark, label))
    where = path.getFileSystem(spark._jsc.hadoopConfiguration())
    where.mkdirs(path)
    return where.makeQualified(path).toString()


def opened(address: str) -> tuple[fs.FileSystem, str]:
    if address.startswith("file:"):  # Hadoop spells it with one slash, others with three
        return fs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(address) if "://" in address else (fs.LocalFileSystem(), address)


def new_file(folder: str, suffix: str) -> str:
    """A name that no other attempt of a task has; only files that a finished task reports are read."""
    return f"{folder}/{uuid.uuid4().hex}.{suffix}"
