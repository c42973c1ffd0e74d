"""The corpus pipeline: each stage applies one operator to all that the stage before it kept.

All stages take null texts, sources and doc_ids, repeated rows, empty tables, and further columns of any
name (names that differ in case only can't be written as Parquet by Spark's default, so they end with ``run``).

* quality_rules: a null, empty or short text fails the base rules and goes; rows that repeat are judged alike.
* near_duplicates: equal rows are one document, also without a doc_id; rows that share a doc_id but not their
  text are documents of their own; of a group the least doc_id stays, null last; texts without words stay.
* secret_scans: a null text stays null.
* mixing: a null source is a source of its own; a text of size 0 is taken no times, or as its class is rounded.
* packing: a null text is its end id.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import jaccard, mixing, packing, quality, secrets
from rowtide.llm.common import rows_back, whole_rows
from rowtide.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; boilerplate lines go from the others."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return jaccard.keep_one(docs, words=5, percent=80)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind."""
    return secrets.redact(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is there as often as the mix takes it."""
    mixed = mixing.mix(whole_rows(docs, "doc_id", "source", "text"), "row").filter("copies > 0")
    copies = mixed.select(F.col("row.row").alias("row"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows_back(copies, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("mixing", mixing_sources),
    ("packing", pack),
]

# Tokenization and Newton steps are beyond SQL; tests/llm/test_pipeline.py has the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored in the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
