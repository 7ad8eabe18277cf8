"""Turning labels into numbers and back, and putting columns on one scale."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.operators.ordering import ordered_rank


def mapping_frame(spark, mapping: dict, key_type: str, value_type: str) -> DataFrame:
    """A dictionary as a two-column table (key, value); how to join it is left to run time."""
    return spark.createDataFrame(list(mapping.items()), f"key {key_type}, value {value_type}")


def lookup(df: DataFrame, col: str, mapping: DataFrame, out: str) -> DataFrame:
    """Left join on a (key, value) table; keys not in the table give NULL."""
    pairs = mapping.select(F.col("key").alias(col), F.col("value").alias(out))
    return df.join(pairs, col, "left")


def replaced(df: DataFrame, col: str, mapping: DataFrame, out: str) -> DataFrame:
    """As ``lookup``, but a value that is not in the table stays as it is."""
    return lookup(df, col, mapping, "_to").withColumn(out, F.coalesce("_to", col)).drop("_to")


def inverted(mapping: DataFrame) -> DataFrame:
    return mapping.select(F.col("value").alias("key"), F.col("key").alias("value"))


def first_appearance_codes(df: DataFrame, label: str, order_by: str) -> DataFrame:
    """(key, value): the distinct labels numbered 1.. by where they first occur."""
    first = df.groupBy(F.col(label).alias("key")).agg(F.min(order_by).alias("_first"))
    return ordered_rank(first, ["_first", "key"], "value").select("key", "value")


def label_indexer(col: str, out: str):
    """Estimator: labels numbered 0.. in alphabetical order."""
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error")


def label_decoder(col: str, out: str, labels: list[str]):
    return IndexToString(inputCol=col, outputCol=out, labels=labels)


def one_hot_encoder(index_col: str, out: str):
    """Estimator: one position per category, none left out."""
    return OneHotEncoder(inputCol=index_col, outputCol=out, dropLast=False)


def one_hot_label(vector_array: Column, labels: list[str]) -> Column:
    """The label whose position holds the 1."""
    at = F.array_position(vector_array, F.array_max(vector_array))
    return F.element_at(F.array(*[F.lit(x) for x in labels]), at.cast("int"))


@dataclass
class ColumnScaler:
    """``x -> (x - shift) / scale`` per column, with the way back."""

    shift: dict[str, float]
    scale: dict[str, float]
    constant: float | None = None  # the value of a column whose scale is 0

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self._forward(c) for c in self.shift})

    def _forward(self, c: str) -> Column:
        if self.scale[c] == 0.0:
            return F.when(F.col(c).isNotNull(), F.lit(0.0 if self.constant is None else self.constant))
        return (F.col(c).cast("double") - F.lit(self.shift[c])) / F.lit(self.scale[c])

    def inverse(self, df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
        """Undo the scaling; ``renames`` maps other columns on a fitted one's scale."""
        targets = renames or {c: c for c in self.shift}
        return df.withColumns({c: F.col(c) * F.lit(self.scale[f]) + F.lit(self.shift[f]) for c, f in targets.items()})


def fit_standard_scaler(df: DataFrame, cols: list[str]) -> ColumnScaler:
    """Mean 0 and sample standard deviation 1, from one aggregate row."""
    aggs = [F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in cols]
    row = df.agg(*aggs).first()
    return ColumnScaler({c: row[c]["m"] for c in cols}, {c: row[c]["s"] or 0.0 for c in cols})


def fit_min_max_scaler(df: DataFrame, cols: list[str]) -> ColumnScaler:
    """The fitted range becomes [0, 1]; new rows may fall outside; constants give 0.5."""
    aggs = [F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols]
    row = df.agg(*aggs).first()
    low = {c: float(row[c]["lo"]) for c in cols}
    return ColumnScaler(low, {c: float(row[c]["hi"]) - low[c] for c in cols}, constant=0.5)


def standardised(df: DataFrame, cols: list[str]) -> DataFrame:
    """Standardise by the table's own statistics in one lazy plan (a scalar subquery); a constant column becomes 0."""
    names = {c: (f"m_{i}", f"s_{i}") for i, c in enumerate(cols)}
    aggs = [a for c, (m, s) in names.items() for a in (F.avg(c).alias(m), F.stddev_samp(c).alias(s))]
    stats = df.agg(*aggs)
    row = stats.select(F.struct(*stats.columns)).scalar()
    return df.withColumns({c: F.when(row[s] > 0, (F.col(c) - row[m]) / F.nullif(row[s], F.lit(0.0))).otherwise(F.col(c) - row[m]) for c, (m, s) in names.items()})


def polynomial_terms(cols: list[str], degree: int) -> dict[str, Column]:
    """All products of 1..degree columns, without the constant."""
    terms = {}
    for d in range(1, degree + 1):
        for combo in combinations_with_replacement(cols, d):
            product = F.col(combo[0]).cast("double")
            for c in combo[1:]:
                product = product * F.col(c).cast("double")
            name = "_".join(combo)
            if name in terms:
                raise ValueError(f"two products would be called {name}; rename a column")
            terms[name] = product
    return terms


def with_polynomial(df: DataFrame, cols: list[str], degree: int) -> DataFrame:
    """All products of the columns up to ``degree`` beside the columns themselves."""
    fresh = {n: e for n, e in polynomial_terms(cols, degree).items() if n not in cols}
    taken = sorted(set(fresh) & set(df.columns))
    if taken:
        raise ValueError(f"the table already has columns called {', '.join(taken)}")
    return df.withColumns(fresh) if fresh else df
