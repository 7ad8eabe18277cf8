"""A join that stays even when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.operators.batches import parts_for

PART_ROWS = 1 << 20


def salted_join(rows: DataFrame, lookup: DataFrame, key: str, spread_by: str, weight: str, pieces: int = 1000, total: int = 0) -> DataFrame:
    """Inner join of ``rows`` with a table of unique keys whose row counts are known.

    ``lookup[weight]`` says how many rows hold the key.  A key with more than
    1/``pieces`` of all rows is cut into that many slices and its lookup row
    repeated per slice.  At most ``pieces`` keys can be that frequent, so the list
    of hot keys is small enough to broadcast whatever the size of the data.  ``total``
    says how many rows there may be, for parts of at most ``PART_ROWS``; 0 leaves that to Spark.
    """
    share = lookup.agg(F.sum(weight) / F.lit(float(pieces))).scalar()
    sized = lookup.withColumn("_salts", F.greatest(F.ceil(F.col(weight) / share), F.lit(1)).cast("int"))
    hot = sized.where(F.col("_salts") > 1).select(key, "_salts")
    spread = sized.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    salt = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_salts")).cast("int"), F.lit(0))
    salted = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")
    parts = parts_for(rows, total, PART_ROWS)
    if parts > rows.sparkSession.sparkContext.defaultParallelism:  # a part stays as small as it is, however many there are
        salted, spread = (side.repartition(parts, key, "_salt") for side in (salted, spread))
    return salted.join(spread, [key, "_salt"]).drop("_salt")
