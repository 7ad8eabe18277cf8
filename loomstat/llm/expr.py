"""Column helpers shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters, as a Java class (fixed by the contracts).
SPACE = r"[ \t\n\x0B\f\r]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, whatever the optimizer collapses."""
    return F.transform(F.array(value), body)[0]


def text_of(docs: DataFrame, text_col: str = "text") -> Column:
    """The text column; NULL counts as empty."""
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space, in order."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def sha256(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
