"""Counting, dropping and filling missing values (NULL; NaN is a value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: (variable, nmissing), from a single pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], list(df.columns), "variable", "nmissing")


def _null_and_row_counts(df: DataFrame) -> tuple[dict[str, int], int]:
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    return {c: row[c] for c in df.columns}, row["_rows"]


def drop_incomplete_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=subset)


def keep_rows_with(df: DataFrame, n: int = 4) -> DataFrame:
    """Rows with at least ``n`` values present."""
    return df.na.drop(thresh=n)


def drop_columns_with_nulls(df: DataFrame) -> DataFrame:
    """Columns without any NULL.  The schema depends on the data: one small job."""
    nulls, _ = _null_and_row_counts(df)
    return df.drop(*[c for c, n in nulls.items() if n > 0])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are NULL in every row."""
    nulls, rows = _null_and_row_counts(df)
    return df.drop(*[c for c, n in nulls.items() if n == rows])


def impute_mean(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill NULLs with the column mean of ``fit_on`` (by default of ``df``)."""
    source = df if fit_on is None else fit_on
    means = source.agg(*[F.avg(c).alias(c) for c in cols]).select(F.struct(*cols)).scalar()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means[c]) for c in cols})
