"""One query per corpus operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import (
    convrepair,
    flatscan,
    hamming,
    htmltext,
    jaccard,
    lmscore,
    mixing,
    packing,
    quality,
    repeats,
    secrets,
    tokenfile,
    whiten,
)
from rowtide.llm.common import table
from rowtide.llm.sql import ORACLES  # noqa: F401

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


@query
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = repeats.strip_repeats(table(spark, sf_dir, "documents"), length=100)
    return stripped.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(table(spark, sf_dir, "pages"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_boiler_words"
    )


@query
def op7_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest codes of every row whose id is divisible by 50."""
    return hamming.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=10)


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as flat files, scanned for their ends; doc_id comes back by order."""
    folder, order = flatscan.write_flat(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), spaced=True, separator=50256
    )
    files = flatscan.listed(spark, folder)
    counted = flatscan.count_tokens(files, separator=50256)
    name = "substring_index(file, '/', -1) AS name"  # addresses of one file may be spelt differently
    return (
        order.selectExpr("doc_id", "ordinal", name)
        .join(counted.selectExpr("*", name), ["name", "ordinal"])
        .select("doc_id", "start", "n_tokens", "terminated")
    )


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfile.write(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), spaced=False, end_id=2
    )
    return tokenfile.read(manifest)


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", secrets.spans().alias("spans"), "n_live", "n_examples"
    )


@query
def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.lm_scores(table(spark, sf_dir, "documents"))


@query
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return convrepair.judged(conversations, convrepair.damaged(conversations))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight leading components; a deviation beyond a long is null."""
    found = whiten.whitened(table(spark, sf_dir, "embeddings"), whiten.Settings(components=8))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))
