"""Choosing, renaming, recoding and adding columns; taking rows by position."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.operators.ordering import ordered_rank


def columns_at(df: DataFrame, positions: list[int]) -> DataFrame:
    """Columns by 0-based position; negative positions count from the end."""
    return df.select(*[df.columns[p] for p in positions])


def all_but(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def renamed(df: DataFrame, names: list[str]) -> DataFrame:
    return df.toDF(*names)


def recode(col: Column, pairs: dict, default=None) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default``."""
    out = None
    for key, value in pairs.items():
        out = F.when(col == key, value) if out is None else out.when(col == key, value)
    return out.otherwise(default)


def null_column(df: DataFrame, name: str, dtype: str = "double") -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(dtype))


def class_probability(k: int, vector: str = "probability") -> Column:
    """Probability of class ``k`` out of a model's probability vector."""
    return vector_to_array(F.col(vector))[k]


def to_features(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Plain numeric columns as one vector of doubles."""
    held = [f"_f_{c}" for c in cols]
    cast = df.select("*", *[F.col(c).cast("double").alias(h) for c, h in zip(cols, held)])
    return VectorAssembler(inputCols=held, outputCol=out).transform(cast).drop(*held)


def rows_between(df: DataFrame, order_by: list[str], start: int, stop: int) -> DataFrame:
    """Rows ``start`` to ``stop`` (1-based, both included) along a unique order."""
    return ordered_rank(df, order_by, "_rn").where(F.col("_rn").between(start, stop)).drop("_rn")


def head_rows(df: DataFrame, order_by: list, start: int, stop: int) -> DataFrame:
    """As ``rows_between`` for rows near the front: tasks keep their first ``stop`` rows, nothing else is sorted."""
    return df.orderBy(*order_by).offset(start - 1).limit(stop - start + 1)
