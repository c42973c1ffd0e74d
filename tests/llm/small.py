"""Small tables for the corpus operators, with the awkward rows that all of them must take."""

from __future__ import annotations

import pandas as pd
import pyarrow.parquet as pq

AWKWARD = [
    (901, None, "en", "src0", None),
    (902, "", "en", None, 0),
    (903, "  \n\t \n", None, "src1", 5),
    (904, "one", "en", "", 3),
    (905, "one", "en", "src2", 3),
    (905, "one", "en", "src2", 3),
    (None, "a row without an id", "en", "src2", 19),
    (906, "word " * 30_000, "en", "src0", 150_000),
    (907, "x" * 200_000, "de", "src0", 200_000),
    (908, "é💡 ü\x0b\x0c  combining é tail", "fr", "src3", 24),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(n: int = 120, sf: str = "sf0.001") -> pd.DataFrame:
    return pq.read_table(f"/root/testdata/{sf}/documents.parquet").to_pandas().head(n)


def documents(spark, n: int = 120, awkward: bool = True, extra: bool = True):
    """Real rows, the awkward ones, and extra columns whose names clash with results and with each other."""
    rows = [tuple(r) for r in frame(n).itertuples(index=False)] + (AWKWARD if awkward else [])
    rows = [(None if r[0] is None else int(r[0]), *r[1:4], None if r[4] is None else int(r[4])) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        names = ["DOC_ID", "Text", "size", "rank", "start", "found", "host", "key", "kept", "n_words", "ids", "length"]
        for name in names:
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def rows_of(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
