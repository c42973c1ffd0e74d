"""Files: cached tables, chunks, work folder."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from rowtide import session
from rowtide.catalog.fixtures import orders
from rowtide.sources.cache import cached_table, finished
from rowtide.sources.chunks import backfill, iter_chunks
from rowtide.sources.tables import read_labels


def test_cache_builds_once(spark, tmp_path):
    path, calls = str(tmp_path / "table"), []

    def build():
        calls.append(1)
        return spark.range(5)

    assert not finished(spark, path)
    assert cached_table(spark, path, build).count() == 5
    assert cached_table(spark, path, build).count() == 5
    assert len(calls) == 1


def test_chunks_keep_entities_whole(spark):
    df = orders(spark, SMALL)
    seen = [
        {r["o_custkey"] for r in part.select("o_custkey").distinct().collect()}
        for part in iter_chunks(df, "o_custkey", 4)
    ]
    assert len(seen) == 4 and sum(map(len, seen)) == len(set().union(*seen))
    counted = backfill(df, "o_custkey", lambda p: p.groupBy("o_custkey").count(), 3)
    assert counted.exceptAll(df.groupBy("o_custkey").count()).isEmpty()


def test_chunk_reads_are_pruned(spark):
    part = next(iter_chunks(orders(spark, SMALL), "o_custkey", 4))
    text = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__chunk_id" in text


def test_labels_are_cast(spark, tmp_path):
    path = str(tmp_path / "labels")
    spark.createDataFrame([("a", 1.0), ("b", 0.0)], "customer string, target double").write.option(
        "header", True
    ).csv(path)
    df = read_labels(spark, path, "customer")
    assert dict(df.dtypes)["target"] == "tinyint" and df.agg(F.sum("target")).first()[0] == 1


def test_work_dir_prefers_the_cluster_setting(spark, monkeypatch):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        class sparkContext:  # noqa: N801
            master = "spark://somewhere"

    fake = Session()
    fake.conf = Conf({"spark.checkpoint.dir": "/shared/here", "spark.rowtide.workDir": "/local"})
    assert session.work_dir(fake) == "/shared/here"
    fake.conf = Conf({})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_dir(fake)
