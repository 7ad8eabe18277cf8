"""A folder tree of text files, one document per file, labels as folder names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_tree(spark: SparkSession, root: str, labels: dict[str, int]) -> DataFrame:
    """(split, text, label) from ``root/<split>/<label>/<file>``."""
    files = (
        spark.read.text(root, wholetext=True, recursiveFileLookup=True)
        .select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"))
    )
    parts = F.split("path", "/")
    named = files.select("text", F.element_at(parts, -3).alias("split"), F.element_at(parts, -2).alias("name"))
    pairs = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return named.select("split", "text", F.element_at(pairs, F.col("name")).alias("label"))
