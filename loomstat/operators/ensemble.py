"""Many models as one: votes, bags and boosting."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.functions.hashing import poisson_weight
from loomstat.session import cut_lineage

GROWN_OUT = 30  # the deepest tree Spark builds; stands for "no depth limit"


def decision_tree(max_depth: int | None = None, seed: int = 1, **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=_depth(max_depth), seed=seed, **params)


def regression_tree(max_depth: int | None = None, seed: int = 1, **params) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(maxDepth=_depth(max_depth), seed=seed, **params)


def random_forest(n_estimators: int = 100, max_depth: int | None = None, seed: int = 1, **params) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=n_estimators, maxDepth=_depth(max_depth), seed=seed, **params)


def regression_forest(n_estimators: int = 100, max_depth: int | None = None, seed: int = 1, **params) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=n_estimators, maxDepth=_depth(max_depth), seed=seed, **params)


def bagged_trees(n_estimators: int, max_samples: float = 1.0, bootstrap: bool = True, max_depth: int | None = None, seed: int = 1, **params) -> RandomForestClassifier:
    """Bagging of trees is a forest whose trees see all features.

    A share of the features per member (not per split) is what ``bag`` draws.
    """
    return RandomForestClassifier(
        numTrees=n_estimators, subsamplingRate=max_samples, featureSubsetStrategy="all", bootstrap=bootstrap, maxDepth=_depth(max_depth), seed=seed, **params
    )


def _depth(max_depth: int | None) -> int:
    return GROWN_OUT if max_depth is None else max_depth


def boosted_trees(n_estimators: int, learning_rate: float, max_depth: int, seed: int = 1, **params) -> GBTClassifier:
    return GBTClassifier(maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth, seed=seed, **params)


def importances(model, names: list[str]) -> DataFrame:
    """(feature, importance) of a fitted tree ensemble."""
    from pyspark.sql import SparkSession

    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def class_probabilities(model: Model, df: DataFrame, key: str) -> DataFrame:
    """(key, p): the model's class probabilities as an array."""
    return model.transform(df).select(key, vector_to_array("probability").alias("p"))


def soft_vote(members: list[DataFrame], key: str, classes: int, weights: list[float] | None = None) -> DataFrame:
    """Weighted mean of the members' class probabilities (key, p) and the best class."""
    weights = weights or [1.0] * len(members)
    tagged = [m.select(key, "p", F.lit(float(w)).alias("_w")) for m, w in zip(members, weights)]
    everyone = reduce(DataFrame.unionByName, tagged)
    means = [(F.sum(F.col("_w") * F.col("p")[c]) / F.sum("_w")).alias(f"p{c}") for c in range(classes)]
    voted = everyone.groupBy(key).agg(*means).select(key, F.array(*[f"p{c}" for c in range(classes)]).alias("p"))
    return voted.withColumn("prediction", (F.array_position("p", F.array_max("p")) - 1).cast("double"))


def member_features(width: int, share: float, replace: bool, member: int, seed: int) -> list[int]:
    """The positions of the features that one member of a bag sees, drawn by hash."""
    n = max(1, round(share * width))
    draws = [int(hashlib.md5(f"{seed}:{member}:{i}".encode()).hexdigest(), 16) for i in range(width if not replace else n)]
    if replace:
        return sorted({d % width for d in draws})
    return sorted(sorted(range(width), key=lambda i: draws[i])[:n])


def bag(
    df: DataFrame, estimator: Estimator, key: str, members: int, seed: int, max_samples: float = 1.0, max_features: float = 1.0, bootstrap_features: bool = False
) -> list[Model]:
    """Fit copies of any estimator that takes row weights, each on its own bootstrap.

    ``max_samples`` scales the number of drawn rows; ``max_features`` is the share of
    the features that a member sees, with ``bootstrap_features`` drawn with replacement.
    """
    out, width = [], None
    for m in range(members):
        drawn = df.withColumn("_w", poisson_weight(seed, F.lit(m), F.col(key), mean=max_samples).cast("double")).where("_w > 0")
        if max_features >= 1.0 and not bootstrap_features:
            out.append(estimator.copy({estimator.weightCol: "_w"}).fit(drawn))
            continue
        features = estimator.getFeaturesCol()
        width = width or len(df.select(features).first()[0])
        slicer = VectorSlicer(inputCol=features, outputCol="_seen", indices=member_features(width, max_features, bootstrap_features, m, seed))
        learner = estimator.copy({estimator.weightCol: "_w", estimator.featuresCol: "_seen"})
        out.append(Pipeline(stages=[slicer, learner]).fit(drawn))
    return out


# ---- adaptive boosting ------------------------------------------------------------------

SMALLEST_ERROR = 1e-10


def boosting_step(df: DataFrame, label: str, prediction: str, weight: str, out: str = "new_weight") -> DataFrame:
    """One re-weighting: right rows shrink, wrong rows grow, the sum is 1 again.

    Adds ``error`` and ``alpha`` of the step; the totals are one scalar subquery.
    A round without errors counts with an error of ``SMALLEST_ERROR``.
    """
    wrong = F.col(label) != F.col(prediction)
    totals = df.agg(F.sum(weight).alias("w"), F.sum(F.when(wrong, F.col(weight)).otherwise(0.0)).alias("e"))
    error = totals.select(F.col("e") / F.col("w")).scalar()
    stepped = df.withColumn("error", error)
    held = F.least(F.greatest(F.col("error"), F.lit(SMALLEST_ERROR)), F.lit(1 - SMALLEST_ERROR))
    raised = stepped.withColumn("alpha", 0.5 * F.ln((1 - held) / held))
    # The sum of the raised weights in closed form.
    total = totals.select("w").scalar() * ((1 - F.col("error")) * F.exp(-F.col("alpha")) + F.col("error") * F.exp(F.col("alpha")))
    factor = F.exp(F.when(wrong, F.col("alpha")).otherwise(-F.col("alpha")))
    return raised.withColumn(out, F.col(weight) * factor / total)


@dataclass
class BoostedModel:
    members: list[Model]
    alphas: list[float]
    errors: list[float]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``score`` (in [-1, 1]) and ``prediction`` (0 or 1)."""
        kept, scored = [c for c in df.columns if c not in ("score", "prediction")], df
        votes = []
        for i, (model, alpha) in enumerate(zip(self.members, self.alphas)):
            renamed = model.copy()
            renamed.setPredictionCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_q{i}")
            scored = renamed.transform(scored).drop(f"_r{i}", f"_q{i}")
            votes.append(F.lit(float(alpha)) * (2 * F.col(f"_p{i}") - 1))
        score = reduce(lambda a, b: a + b, votes) / F.lit(float(sum(abs(a) for a in self.alphas)))
        return scored.select(*kept, score.alias("score")).withColumn("prediction", (F.col("score") > 0).cast("double"))


def adaboost(df: DataFrame, base: Estimator, n_estimators: int, learning_rate: float = 1.0, label: str = "label", features: str = "features", checkpoint_every: int = 5) -> BoostedModel:
    """Boost a weighted binary classifier (labels 0 and 1).

    The rows of a round are kept until the next round's are made, so a round runs
    one model over them; their plan is cut by writing them every few rounds.
    """
    rows = cut_lineage(df.select(features, F.col(label).cast("double").alias(label), F.lit(1.0).alias("_w")))
    fitted, held = BoostedModel([], [], []), []
    for turn in range(n_estimators):
        model = base.copy({base.weightCol: "_w", base.labelCol: label, base.featuresCol: features}).fit(rows)
        seen = model.transform(rows).select(features, label, "_w", "prediction").persist()
        held.append(seen)
        wrong = F.col("prediction") != F.col(label)
        totals = seen.agg(F.sum("_w"), F.sum(F.when(wrong, F.col("_w")).otherwise(0.0))).first()
        error = totals[1] / totals[0]
        if error >= 0.5:
            break
        safe = max(error, SMALLEST_ERROR)
        alpha = learning_rate * 0.5 * math.log((1 - safe) / safe)
        fitted.members.append(model)
        fitted.alphas.append(alpha)
        fitted.errors.append(error)
        if error == 0.0:
            break
        factor = F.exp(F.when(wrong, F.lit(alpha)).otherwise(F.lit(-alpha)))
        rows = seen.select(features, label, (F.col("_w") * factor / F.lit(totals[0])).alias("_w"))
        if (turn + 1) % checkpoint_every == 0:
            rows = cut_lineage(rows)
        for old in held[: -1 if (turn + 1) % checkpoint_every else None]:
            old.unpersist()
        del held[: -1 if (turn + 1) % checkpoint_every else None]
    for old in held:
        old.unpersist()
    return fitted
