"""Label, side-feature and prediction files (CSV with header)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.sources.panel import unify_missing


def read_labels(
    spark: SparkSession, path: str, entity: str, target: str = "target", entity_type: str = "string"
) -> DataFrame:
    schema = f"`{entity}` {entity_type}, `{target}` double"
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumn(target, F.col(target).cast("tinyint"))


def read_side_features(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return unify_missing(spark.read.schema(schema).option("header", True).csv(path))


def write_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_predictions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
