"""Splits, folds and resamples: exact, seeded, and the same on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loomstat.functions.hashing import poisson_weight, seeded_hash, uniform
from loomstat.operators.ordering import hashed_rank, ordered_rank

_DIGITS, _STRATA = 3, 1000  # digits that rows are counted by; strata whose borders the driver holds


def stratified_split(df: DataFrame, key: str | Column, label: str, test_size: float, seed: int, out: str = "is_test") -> DataFrame:
    """Mark ``floor(test_size * n)`` rows of each label as test rows."""
    return _split(df, key, [label], test_size, seed, out)


def random_split(df: DataFrame, key: str | Column, test_size: float, seed: int, out: str = "is_test") -> DataFrame:
    """As above without strata."""
    return _split(df, key, [], test_size, seed, out)


def _split(df: DataFrame, key: str | Column, by: list[str], test_size: float, seed: int, out: str) -> DataFrame:
    """The rows of smallest hash of each group are test rows.

    Rows are counted by the first digits of their hash.  Only those with the digits that the
    border falls on (one in ``16**_DIGITS``) are ranked; the others stay where they are.  With
    more than ``_STRATA`` groups all rows are ranked.
    """
    hashed = df.withColumn("_h", seeded_hash(seed, key)).withColumn("_digits", F.substring("_h", 1, _DIGITS))
    wanted = F.floor(F.lit(test_size) * F.col("_n"))
    sizes = hashed.groupBy(*by, "_digits").agg(F.count(F.lit(1)).alias("_size"))
    group = Window.partitionBy(*[F.col(b) for b in by])
    so_far = F.coalesce(F.sum("_size").over(group.orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    borders = sizes.select(*by, "_digits", so_far.alias("_before"), F.sum("_size").over(group).alias("_n"), "_size").withColumn("_take", wanted - F.col("_before"))
    borders = borders.where((F.col("_take") >= 0) & (F.col("_take") < F.col("_size"))).limit(_STRATA + 1).collect()
    if len(borders) > _STRATA:
        ranked = hashed_rank(hashed.drop("_digits"), "_h", by=by, out="_rn", total="_n")
        return ranked.withColumn(out, F.col("_rn") <= wanted).drop("_h", "_rn", "_n")
    row = [*[df.schema[b] for b in by], StructField("_border", StringType()), StructField("_take", LongType())]
    held = df.sparkSession.createDataFrame([(*[b[c] for c in by], b["_digits"], b["_take"]) for b in borders], StructType(row))
    key_of = F.struct(F.lit(0).alias("_"), *by)  # NULL groups join like any other
    placed = hashed.withColumn("_group", key_of).join(F.broadcast(held.select(key_of.alias("_group"), "_border", "_take")), "_group", "left")
    sure = placed.where(~F.coalesce(F.col("_digits") == F.col("_border"), F.lit(False)))  # no border: every row is a test row
    sure = sure.withColumn(out, F.coalesce(F.col("_digits") < F.col("_border"), F.lit(True)))
    within = F.row_number().over(Window.partitionBy(*by, "_digits").orderBy("_h"))
    unsure = placed.where(F.col("_digits") == F.col("_border")).withColumn(out, within <= F.col("_take"))
    return sure.unionByName(unsure).select(*df.columns, out)


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int | None = None, out: str = "fold") -> DataFrame:
    """Deal the rows of each label to ``k`` folds, by key or (with a seed) shuffled."""
    if seed is None:
        ranked = ordered_rank(df, [key], "_rn", by=[label])
    else:
        ranked = hashed_rank(df.withColumn("_h", seeded_hash(seed, key)), "_h", by=[label], out="_rn").drop("_h")
    return ranked.withColumn(out, ((F.col("_rn") - 1) % k).cast("int")).drop("_rn")


def resample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement; column ``draw`` numbers them.

    Draws are uniform over positions, so the join below has no hot key.
    """
    draws = df.sparkSession.range(n).withColumnRenamed("id", "draw")
    size = df.agg(F.count(F.lit(1))).scalar()
    picked = draws.withColumn("_rn", F.floor(uniform(seed, "draw") * size) + 1)
    return picked.join(ordered_rank(df, [key], "_rn"), "_rn").drop("_rn")


def rebalanced(df: DataFrame, key: str, label: str, majority, minority, seed: int) -> DataFrame:
    """All majority rows and as many resampled minority rows."""
    major = df.where(F.col(label) == majority)
    upsampled = resample(df.where(F.col(label) == minority), key, major.count(), seed).drop("draw")
    return major.unionByName(upsampled)


def bootstrap_weights(df: DataFrame, key: str | Column, members: int, seed: int, share: float = 1.0) -> DataFrame:
    """One row per (member, row): how often that member's bootstrap draws the row.

    A member draws about ``share`` times as many rows as there are.  Poisson weights
    need no counting and no shuffle; rows of weight 0 are left out.
    """
    spread = df.withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(members - 1))))
    return spread.withColumn("weight", poisson_weight(seed, "member", key, mean=share)).where("weight > 0")


def shuffled(df: DataFrame, key: str | Column, seed: int) -> DataFrame:
    """All rows in a seeded random order (a distributed sort)."""
    return df.withColumn("_h", seeded_hash(seed, key)).orderBy("_h").drop("_h")
