"""Principal components and topics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.functions.maths import linear_score
from loomstat.operators.stats import covariance_matrix


@dataclass
class Components:
    """Eigenvalues in descending order and their vectors as columns, signs fixed."""

    values: np.ndarray
    vectors: np.ndarray

    def explained(self) -> np.ndarray:
        return self.values / self.values.sum()

    def loadings(self) -> np.ndarray:
        """Vector entries times the root of their eigenvalue."""
        return self.vectors * np.sqrt(np.maximum(self.values, 0.0))

    def frame(self, spark, names: list[str]) -> DataFrame:
        """(component, variance, ratio, cumulative, feature, weight, loading), long."""
        ratio, load = self.explained(), self.loadings()
        total = np.cumsum(ratio)
        rows = [
            (c, float(self.values[c]), float(ratio[c]), float(total[c]), name, float(self.vectors[i, c]), float(load[i, c]))
            for c in range(len(self.values))
            for i, name in enumerate(names)
        ]
        return spark.createDataFrame(
            rows, "component bigint, variance double, ratio double, cumulative double, feature string, weight double, loading double"
        )

    def project(self, df: DataFrame, cols: list[str], k: int, prefix: str = "pc") -> DataFrame:
        """Add the first ``k`` scores as column expressions."""
        xs = [F.col(c) for c in cols]
        return df.withColumns({f"{prefix}{c}": linear_score(xs, list(self.vectors[:, c]), 0.0) for c in range(k)})


def positive_signs(vectors: np.ndarray) -> np.ndarray:
    """Turn each column so that its entry of largest magnitude is positive."""
    at = np.abs(vectors).argmax(axis=0)
    return vectors * np.sign(vectors[at, np.arange(vectors.shape[1])])


def eigen(matrix: np.ndarray) -> Components:
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1]
    return Components(values[order], positive_signs(vectors[:, order]))


def matrix_of(cells: DataFrame, width: int) -> np.ndarray:
    """A small matrix out of its long form (i, j, value)."""
    out = np.zeros((width, width))
    for row in cells.collect():
        out[row["i"], row["j"]] = row["value"]
    return out


def components(df: DataFrame, cols: list[str]) -> Components:
    """Eigenvectors of the covariance matrix; only the matrix reaches the driver."""
    return eigen(matrix_of(covariance_matrix(df, cols), len(cols)))


def scaled_pca(k: int, features: str = "features", out: str = "pca") -> Pipeline:
    """Estimator: centre and scale, then project on ``k`` components."""
    scale = StandardScaler(inputCol=features, outputCol=f"{out}_scaled", withMean=True, withStd=True)
    return Pipeline(stages=[scale, PCA(k=k, inputCol=f"{out}_scaled", outputCol=out)])


def fit_topics(counts: DataFrame, topics: int, max_iter: int = 10, seed: int = 123, features: str = "features") -> LDAModel:
    """Batch variational topic model on sparse count vectors."""
    lda = LDA(k=topics, maxIter=max_iter, seed=seed, optimizer="online", subsamplingRate=1.0, featuresCol=features)
    kept = counts.select(features).persist()  # every round reads all documents
    try:
        return lda.fit(kept)
    finally:
        kept.unpersist()


def top_words(model: LDAModel, vocab: DataFrame, n: int = 5) -> DataFrame:
    """(topic, rank, term, weight) from the fitted topics and the vocabulary (term, idx)."""
    pairs = F.arrays_zip("termIndices", "termWeights")
    rows = model.describeTopics(n).select(F.col("topic").cast("bigint").alias("topic"), F.posexplode(pairs).alias("rank", "p"))
    indexed = rows.select("topic", F.col("rank").cast("bigint").alias("rank"), F.col("p.termIndices").cast("bigint").alias("idx"), F.col("p.termWeights").alias("weight"))
    return indexed.join(vocab.select("idx", "term"), "idx").select("topic", "rank", "term", "weight")
