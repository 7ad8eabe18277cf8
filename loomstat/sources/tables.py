"""Parquet tables, labelled datasets and literal frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def labelled(df: DataFrame, key, features: list[str], label) -> DataFrame:
    """(id, features..., label): features as doubles, the label in the same row."""
    key = F.col(key) if isinstance(key, str) else key
    label = F.col(label) if isinstance(label, str) else label
    return df.select(key.alias("id"), *[F.col(c).cast("double").alias(c) for c in features], label.alias("label"))


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
