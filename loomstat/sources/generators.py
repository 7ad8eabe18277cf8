"""Generated data: every value is a function of a seed and a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions.hashing import gaussian, uniform


def blobs(keys: DataFrame, key: str, n_features: int, centers: int, std: float, seed: int, box: float = 10.0) -> DataFrame:
    """(key, center, x0, x1, ...): normal clouds around centres drawn in a box.

    The keys decide the number of rows; key modulo ``centers`` deals them out evenly.
    """
    center = F.pmod(F.col(key), F.lit(centers)).cast("bigint")
    columns = []
    for f in range(n_features):
        middle = uniform(seed, F.lit("c"), center, F.lit(f)) * F.lit(2.0 * box) - F.lit(box)
        columns.append((middle + F.lit(float(std)) * gaussian(seed, F.lit("x"), F.col(key), F.lit(f))).alias(f"x{f}"))
    return keys.select(F.col(key), center.alias("center"), *columns)


def uniform_matrix(keys: DataFrame, key: str, width: int, label: Column, seed: int) -> DataFrame:
    """(key, x0, ..., label) with uniform columns and a label given by the caller."""
    return keys.select(F.col(key), *[uniform(seed, F.col(key), F.lit(f)).alias(f"x{f}") for f in range(width)], label.alias("label"))


def range_rows(df: DataFrame, start: Column, stop: Column, step: Column, out: str) -> DataFrame:
    """``start, start + step, ... <= stop`` for each row of a small frame."""
    return df.select("*", F.explode(F.sequence(start, stop, step)).alias(out))
