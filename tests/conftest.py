from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import database, spark_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(**{"spark.rowtide.workDir": str(tmp_path_factory.mktemp("work"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def db():
    return database(SMALL)


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    changed = []

    def set_(key, value):
        changed.append((key, spark.conf.get(key, None)))
        spark.conf.set(key, str(value))

    yield set_
    for key, old in reversed(changed):
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
