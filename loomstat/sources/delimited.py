"""Delimited text files with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", multiline: bool = False, header: bool = True) -> DataFrame:
    """Empty cells and cells missing at the end of a row become NULL.

    ``multiline`` allows line breaks inside quoted cells; such a file is read by
    one task, so keep multi-line tables in many files.
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("sep", sep)
        .option("multiLine", multiline)
        .option("escape", '"')
        .csv(path)
    )


def read_csv_text(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """A literal CSV string (header line first)."""
    lines = text.strip("\n").split("\n")
    frame = spark.createDataFrame([(line,) for line in lines[1:]], "value string")
    parsed = F.from_csv("value", schema, {"mode": "PERMISSIVE"})
    return frame.select(parsed.alias("r")).select("r.*")


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """A folder of CSV parts with headers; quotes are doubled, as readers expect."""
    (
        df.write.option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
