"""Run queries next to their SQL and compare the full results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def spark_session(**conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return repr(float(v) + 0.0)
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, db, sql) -> str | None:
    got_cols, got = normal(df.columns, [tuple(r) for r in df.collect()])
    rel = db.sql(sql)
    want_cols, want = normal(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(c, a, b) for c, a, b in zip(got_cols, g, w, strict=True) if a != b]
        return f"{len(bad)} rows differ, first: {cells[:4]}"
    return None


def main() -> None:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark, db = spark_session(), database(sf_dir)
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        sql = entry.oracle_sql().get(name)
        try:
            if sql is None:
                result = f"no SQL, {fn(spark, sf_dir).count()} rows"
            else:
                result = difference(fn(spark, sf_dir), db, sql) or "ok"
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24s} {time.time() - start:6.2f}s  {result}", flush=True)


if __name__ == "__main__":
    main()
