"""Neighbours, votes, bags and boosting as Spark ML estimators.

They fit into ``Pipeline``, ``fold_scores`` and searches like any other: every model
adds ``probability``, ``rawPrediction`` (the same numbers) and ``prediction``.
"""

from __future__ import annotations

import copy

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.operators import ensemble
from loomstat.operators.neighbors import nearest
from loomstat.session import cut_lineage

_MADE = ["rawPrediction", "probability", "prediction"]


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    pass


def _with_votes(df: DataFrame, shares: Column, kept: list[str]) -> DataFrame:
    """Probabilities, given as an array by class 0, 1, ..., as the usual three columns."""
    voted = df.withColumn("_shares", shares)
    best = (F.array_position("_shares", F.array_max("_shares")) - 1).cast("double")
    vector = array_to_vector("_shares")
    return voted.select(*kept, vector.alias("rawPrediction"), vector.alias("probability"), best.alias("prediction"))


class NearestNeighbours(Estimator, _Columns):
    """Class shares among the ``k`` nearest training rows; ``key`` names a unique column of the training rows."""

    def __init__(self, k: int = 5, key: str = "id", classes: int = 2, features: str = "features", label: str = "label"):
        super().__init__()
        self.k, self.key, self.classes = k, key, classes
        self._set(featuresCol=features, labelCol=label)

    def _fit(self, df: DataFrame) -> NearestNeighboursModel:
        vec = vector_to_array(self.getFeaturesCol()).alias("vec")
        rows = cut_lineage(df.select(F.col(self.key).alias("key"), vec, F.col(self.getLabelCol()).cast("double").alias("label")))
        return NearestNeighboursModel(rows, self.k, self.classes, self.getFeaturesCol())


class NearestNeighboursModel(Model, _Columns):
    def __init__(self, rows: DataFrame, k: int, classes: int, features: str):
        super().__init__()
        self.rows, self.k, self.classes = rows, k, classes
        self._set(featuresCol=features)

    def _transform(self, df: DataFrame) -> DataFrame:
        """Equal feature vectors ask once; rows get the answer of their vector."""
        kept = [c for c in df.columns if c not in _MADE]
        asked = df.select(*kept, vector_to_array(self.getFeaturesCol()).alias("_vec"))
        queries = cut_lineage(asked.select(F.col("_vec").alias("vec")).distinct().select("vec", F.to_json(F.struct("vec")).alias("key")))
        train = self.rows.select(F.col("key").cast("string").alias("key"), "vec", "label", F.col("key").alias("_order"))
        near = nearest(train, queries, "key", "vec", "label", self.k)
        shares = [F.avg((F.col("label") == float(c)).cast("double")) for c in range(self.classes)]
        votes = near.groupBy(F.col("query").alias("key")).agg(F.array(*shares).alias("_votes")).join(queries, "key")
        return _with_votes(asked.join(votes.select(F.col("vec").alias("_vec"), "_votes"), "_vec"), F.col("_votes"), kept)


class SoftVote(Estimator, _Columns):
    """Weighted mean of the probabilities of named estimators, all fitted to the same rows."""

    def __init__(self, members: list[tuple[str, Estimator]], weights: list[float] | None = None):
        super().__init__()
        self.members, self.weights = members, weights

    def _fit(self, df: DataFrame) -> VoteModel:
        return VoteModel([m.fit(df) for _, m in self.members], self.weights)


class VoteModel(Model, _Columns):
    def __init__(self, models: list[Model], weights: list[float] | None = None):
        super().__init__()
        self.models, self.weights = models, weights or [1.0] * len(models)

    def _transform(self, df: DataFrame) -> DataFrame:
        """Every model scores the same row in turn; nothing is joined but what a member joins itself."""
        kept = [c for c in df.columns if c not in _MADE]
        scored, names = df.select(*kept), []
        for i, model in enumerate(self.models):
            scored = model.transform(scored).select(*kept, *names, vector_to_array("probability").alias(f"_vote{i}"))
            names.append(f"_vote{i}")
        mean = F.transform(F.col(names[0]), lambda p: p * F.lit(0.0))
        for name, weight in zip(names, self.weights):
            mean = F.zip_with(mean, F.col(name), _weighted(weight / sum(self.weights)))
        return _with_votes(scored, mean, kept)


def _weighted(weight: float):
    return lambda total, p: total + p * F.lit(float(weight))


class Bagging(Estimator, _Columns):
    """``members`` copies of an estimator with row weights, each fitted to its own bootstrap (see ``ensemble.bag``)."""

    def __init__(self, estimator: Estimator, members: int, key: str = "id", seed: int = 1, max_samples: float = 1.0, max_features: float = 1.0, bootstrap_features: bool = False):
        super().__init__()
        self.estimator, self.key = estimator, key
        self.options = dict(members=members, seed=seed, max_samples=max_samples, max_features=max_features, bootstrap_features=bootstrap_features)

    def _fit(self, df: DataFrame) -> VoteModel:
        return VoteModel(ensemble.bag(df, self.estimator, self.key, **self.options))


class AdaBoost(Estimator, _Columns):
    """Boosting of a weighted binary classifier (see ``ensemble.adaboost``)."""

    def __init__(self, base: Estimator, n_estimators: int = 50, learning_rate: float = 1.0, features: str = "features", label: str = "label"):
        super().__init__()
        self.base, self.n_estimators, self.learning_rate = base, n_estimators, learning_rate
        self._set(featuresCol=features, labelCol=label)

    def _fit(self, df: DataFrame) -> AdaBoostModel:
        return AdaBoostModel(ensemble.adaboost(df, self.base, self.n_estimators, self.learning_rate, self.getLabelCol(), self.getFeaturesCol()))


class AdaBoostModel(Model, _Columns):
    """The probability of class 1 is the logistic function of twice the weighted vote."""

    def __init__(self, boosted: ensemble.BoostedModel):
        super().__init__()
        self.boosted = boosted

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c not in _MADE]
        scored = self.boosted.transform(df.select(*kept))
        total = F.lit(2.0 * sum(abs(a) for a in self.boosted.alphas))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-total * F.col("score")))
        return _with_votes(scored, F.array(F.lit(1.0) - p, p), kept)


def with_params(estimator: Estimator, **changes) -> Estimator:
    """A copy of one of these estimators with some of its plain settings changed."""
    made = copy.copy(estimator)
    for name, value in changes.items():
        if not hasattr(made, name):
            raise AttributeError(f"{type(made).__name__} has no setting {name}")
        setattr(made, name, value)
    return made
