"""Connected components of a large graph by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the smallest node that can be reached.

    A large-star round hangs the larger neighbours of each node on its smallest one, a
    small-star round the smaller ones; both keep the components.  Paths shrink by a
    factor per pair of rounds, so the number of rounds grows with the logarithm of the
    longest path.  Minima combine before the shuffle, so a hub's edges never meet in one
    task for it; the join that follows may be split at run time.
    """
    now = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = cut_lineage(large.where("u <> v").distinct())
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        small = hung.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = cut_lineage(small.where("u <> v").distinct())
        before, state = state, _state(now)
        if before == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % F.lit(1 << 30))).first()
    return tuple(row)
