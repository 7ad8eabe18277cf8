"""Counts, moments, deviations, votes and impurity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstat.operators.batches import matrix
from loomstat.operators.ordering import ordered_rank


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def weighted_vote(df: DataFrame, key: str, vote: str, weight: str) -> DataFrame:
    """The vote with the largest weight sum per key; ties go to the smallest vote."""
    sums = df.groupBy(key, vote).agg(F.sum(weight).alias("_w"))
    first = sums.groupBy(key).agg(F.min(F.struct((-F.col("_w")).alias("w"), F.col(vote).alias("v"))).alias("_best"))
    return first.select(key, F.col("_best.v").alias(vote), (-F.col("_best.w")).alias("weight"))


def weighted_mean_vote(df: DataFrame, key: str, probs: list[str], weight: str) -> DataFrame:
    """Weighted mean of the class probabilities per key and the best class."""
    means = df.groupBy(key).agg(*[(F.sum(F.col(weight) * F.col(p)) / F.sum(weight)).alias(p) for p in probs])
    return means.withColumn("winner", argmax([F.col(p) for p in probs]))


def argmax(cols: list[Column]) -> Column:
    """0-based position of the largest value, the first one on ties."""
    values = F.array(*cols)
    return (F.array_position(values, F.array_max(values)) - 1).cast("bigint")


def covariance_matrix(df: DataFrame, cols: list[str], correlation: bool = False) -> DataFrame:
    """Long matrix (i, j, value) with 0-based positions, from one aggregate.

    The number of aggregates grows with the square of the columns; for wide
    vectors use ``vector_covariance``.
    """
    f = F.corr if correlation else F.covar_samp
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[f(cols[i], cols[j]).alias(f"c_{i}_{j}") for i, j in pairs])
    cells = []
    for i, j in pairs:
        for a, b in {(i, j), (j, i)}:
            cells.append(F.struct(F.lit(a).cast("bigint").alias("i"), F.lit(b).cast("bigint").alias("j"), F.col(f"c_{i}_{j}").alias("value")))
    return row.select(F.inline(F.array(*cells)))


def vector_covariance(df: DataFrame, array_col: str, width: int) -> DataFrame:
    """Covariance of an array column of fixed width, long form (i, j, value).

    Every task adds up its own products and hands on ``width`` rows; those
    partial sums are all that is shuffled.
    """
    centre_row = df.select(*[F.avg(F.col(array_col)[k].cast("double")).alias(f"m{k}") for k in range(width)]).first()
    centre = np.array(list(centre_row))

    def partial(batches):
        total, n = np.zeros((width, width)), 0
        for batch in batches:
            x = matrix(batch.column(0)) - centre
            total += x.T @ x
            n += len(x)
        if n:
            rows = [pa.array(range(width), pa.int64()), pa.array([n] * width, pa.int64()), pa.array(total.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(rows, ["i", "n", "row"])

    sums = df.select(F.col(array_col).cast("array<double>")).mapInArrow(partial, "i bigint, n bigint, row array<double>")
    cells = sums.select("i", "n", F.posexplode("row").alias("j", "v"))
    return cells.groupBy("i", F.col("j").cast("bigint").alias("j")).agg((F.sum("v") / (F.sum("n") - 1)).alias("value"))


def mean_absolute_deviation(df: DataFrame, col: str) -> DataFrame:
    """Mean distance from the mean."""
    centre = df.agg(F.avg(col)).scalar()
    return df.agg(F.avg(F.abs(F.col(col) - centre)).alias("mad"))


def impurity(df: DataFrame, group: str, label: str) -> DataFrame:
    """Entropy (bits), Gini index and misclassification share per group."""
    counts = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("c"))
    shares = counts.withColumn("p", F.col("c") / F.sum("c").over(Window.partitionBy(group)))
    return shares.groupBy(group).agg(
        (-F.sum(F.col("p") * F.log2("p"))).alias("entropy"),
        (1 - F.sum(F.col("p") * F.col("p"))).alias("gini"),
        (1 - F.max("p")).alias("error"),
    )


def normalised(df: DataFrame, col: str, out: str) -> DataFrame:
    """The column divided by its sum over all rows; NULL where the sum is 0."""
    total = df.agg(F.nullif(F.sum(col), F.lit(0))).scalar()
    return df.withColumn(out, F.col(col) / total)


def top_k(df: DataFrame, by: list[str], order_by: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group.

    Each row carries a slice number, so that a group holding most of the rows is
    ranked by many tasks first; at most ``k`` rows per slice meet in the end.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(64)))
    inner = Window.partitionBy(*by, "_slice").orderBy(*order_by)
    outer = Window.partitionBy(*by).orderBy(*order_by)
    kept = sliced.withColumn("_r", F.row_number().over(inner)).where(F.col("_r") <= k)
    return kept.withColumn("rank", F.row_number().over(outer)).where(F.col("rank") <= k).drop("_slice", "_r")


def sorted_within(df: DataFrame, group: str, order_by: list[str], out: str = "pos") -> DataFrame:
    """Position of every row inside its group; hot groups are cut into ranges."""
    return ordered_rank(df, order_by, out, by=[group])
