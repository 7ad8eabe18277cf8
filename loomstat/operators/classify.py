"""Classifiers: Spark ML estimators where Spark has them, DataFrame jobs where not."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, OneVsRestModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCol, HasLabelCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions.hashing import seeded_hash
from loomstat.operators.batches import matrix, summed
from loomstat.operators.ordering import running_totals
from loomstat.session import cut_lineage

# ---- perceptrons ------------------------------------------------------------------


@dataclass
class PerceptronFit:
    """One row of weights per class, the bias first; ``losses`` counts errors per epoch."""

    weights: np.ndarray
    losses: list[int] = field(default_factory=list)

    def predict(self, features: Column) -> Column:
        """Class of the largest score (the first on ties)."""
        scores = []
        for row in self.weights:
            terms = F.zip_with(features, F.array(*[F.lit(float(w)) for w in row[1:]]), lambda x, w: x * w)
            scores.append(F.aggregate(terms, F.lit(float(row[0])), lambda a, b: a + b))
        values = F.array(*scores)
        return (F.array_position(values, F.array_max(values)) - 1).cast("bigint")


def perceptron(df: DataFrame, key: str, features: list[str], label: str, classes: int = 2, eta: float = 0.1, num_iter: int = 10, seed: int = 1, shards: int = 16, batch: int = 32) -> PerceptronFit:
    """Perceptron by parameter mixing: every shard learns for an epoch, weights are averaged.

    A seeded hash of the key deals the rows to ``shards`` shards and orders them; they are
    written once.  Inside a shard ``batch`` rows at a time update the weights; what a shard
    learns depends on its rows alone, not on tasks or on the batches they arrive in.
    """
    vec = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in features])
    rows = df.select(F.col(label).cast("int").alias("y"), vec.alias("x"), seeded_hash(seed, key).alias("_h"))
    rows = rows.withColumn("shard", F.conv(F.substring("_h", -4, 4), 16, 10).cast("int") % shards)
    rows = cut_lineage(rows.repartition(shards, "shard").sortWithinPartitions("shard", "_h", "y", "x").select("shard", "y", "x"))
    fit = PerceptronFit(np.zeros((classes, len(features) + 1)))
    for _ in range(num_iter):
        start = fit.weights

        def epoch(batches, start=start):
            """Weights times rows seen, the rows, the errors: what the mean needs."""
            total = np.zeros(start.size + 2)
            w, shard = start.copy(), None
            wait_x, wait_y = np.empty((0, start.shape[1])), np.empty(0, dtype=int)

            def learn(x, y):
                guess = (x @ w.T).argmax(axis=1)
                wrong = guess != y
                np.add.at(w, y[wrong], eta * x[wrong])
                np.add.at(w, guess[wrong], -eta * x[wrong])
                total[-2:] += len(y), wrong.sum()
                return len(y)

            seen = 0
            for part in batches:
                shards_of, y_all, x_all = part.column(0).to_numpy(), part.column(1).to_numpy(), matrix(part.column(2))
                edges = [0, *(np.flatnonzero(np.diff(shards_of)) + 1), len(y_all)]
                for lo, hi in zip(edges, edges[1:]):
                    if shards_of[lo] != shard:
                        if len(wait_y):
                            seen += learn(wait_x, wait_y)
                        total[:-2] += w.ravel() * seen
                        w[:], seen, shard = start, 0, shards_of[lo]
                        wait_x, wait_y = wait_x[:0], wait_y[:0]
                    x, y = np.concatenate([wait_x, x_all[lo:hi]]), np.concatenate([wait_y, y_all[lo:hi]])
                    whole = len(y) - len(y) % batch
                    for at in range(0, whole, batch):
                        seen += learn(x[at : at + batch], y[at : at + batch])
                    wait_x, wait_y = x[whole:], y[whole:]
            if len(wait_y):
                seen += learn(wait_x, wait_y)
            total[:-2] += w.ravel() * seen
            return total

        total = summed(rows, epoch, start.size + 2)
        fit.weights = (total[:-2] / max(total[-2], 1)).reshape(start.shape)
        fit.losses.append(int(total[-1]))
    return fit


# ---- logistic regression ------------------------------------------------------------


def logistic(l2: float = 0.0, max_iter: int = 100, features: str = "features", label: str = "label", **columns) -> LogisticRegression:
    """L-BFGS logistic regression: mean log-loss plus ``l2 / 2 |w|^2``."""
    return LogisticRegression(
        regParam=l2, elasticNetParam=0.0, standardization=False, maxIter=max_iter, featuresCol=features, labelCol=label, **columns
    )


def regularisation_path(df: DataFrame, l2s: list[float], names: list[str], max_iter: int = 100) -> DataFrame:
    """(l2, feature, weight) of one logistic regression per penalty."""
    base = logistic(max_iter=max_iter)
    settings = [{base.regParam: float(v)} for v in l2s]
    kept = df.persist()
    try:
        rows = [
            (float(l2s[i]), name, float(w)) for i, model in base.fitMultiple(kept, settings) for name, w in zip(names, model.coefficients.toArray())
        ]
    finally:
        kept.unpersist()
    return df.sparkSession.createDataFrame(rows, "l2 double, feature string, weight double")


def one_vs_rest(classifier, label: str = "label", features: str = "features", parallelism: int = 4) -> OneVsRest:
    return OneVsRest(classifier=classifier, labelCol=label, featuresCol=features, parallelism=parallelism)


def one_vs_rest_probabilities(model: OneVsRestModel, df: DataFrame, out: str = "probs") -> DataFrame:
    """Each member's own probability of "its class", scaled to sum 1 (array by class)."""
    scored = df
    for k, member in enumerate(model.models):
        renamed = member.copy()
        renamed.setRawPredictionCol(f"_raw{k}").setPredictionCol(f"_pred{k}")
        scored = renamed.setProbabilityCol(f"_prob{k}").transform(scored) if hasattr(renamed, "setProbabilityCol") else renamed.transform(scored)
    def own(k):
        if f"_prob{k}" in scored.columns:
            return vector_to_array(F.col(f"_prob{k}"))[1]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-vector_to_array(F.col(f"_raw{k}"))[1]))

    shares = F.array(*[own(k) for k in range(len(model.models))])
    total = F.aggregate(shares, F.lit(0.0), lambda a, b: a + b)
    return scored.withColumn(out, F.transform(shares, lambda p: p / total)).select(*df.columns, out)


# ---- support vectors --------------------------------------------------------------------


class FourierFeatures(Estimator, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Random cosine features whose inner products approach a Gaussian kernel.

    ``gamma`` 0 stands for 1 / (width * variance of all inputs), measured at fit.
    """

    gamma = Param(Params._dummy(), "gamma", "kernel width; 0 = by the data's variance", typeConverter=TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "number of features", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="fourier", gamma=0.0, size=64, seed=1):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="fourier", gamma=0.0, size=64, seed=1)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "FourierFeaturesModel":
        x = vector_to_array(F.col(self.getInputCol()))
        width = df.select(F.size(x)).first()[0]
        gamma = self.getOrDefault(self.gamma)
        if gamma == 0.0:
            spread = df.agg(F.sum(F.aggregate(x, F.lit(0.0), lambda a, v: a + v)), F.sum(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)), F.count(F.lit(1))).first()
            cells = spread[2] * width
            variance = spread[1] / cells - (spread[0] / cells) ** 2
            gamma = 1.0 / (width * variance) if variance > 0 else 1.0
        waves, phases = fourier_waves(width, self.getOrDefault(self.size), gamma, self.getSeed())
        return FourierFeaturesModel(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), waves=waves.ravel().tolist(), phases=phases.tolist())


def fourier_waves(width: int, size: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (size x width) and phases of the cosine features."""
    rng = np.random.default_rng(seed)
    return rng.normal(scale=np.sqrt(2.0 * gamma), size=(size, width)), rng.uniform(0.0, 2.0 * np.pi, size)


def fourier_columns(xs: list[Column], waves: np.ndarray, phases: np.ndarray) -> list[Column]:
    scale = F.lit(float(np.sqrt(2.0 / len(phases))))
    out = []
    for wave, phase in zip(waves, phases):
        z = F.lit(float(phase))
        for x, w in zip(xs, wave):
            z = z + x * F.lit(float(w))
        out.append(scale * F.cos(z))
    return out


class FourierFeaturesModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted cosine features; directions (row by row) and phases are parameters, so it can be saved."""

    waves = Param(Params._dummy(), "waves", "directions, one after another", typeConverter=TypeConverters.toListFloat)
    phases = Param(Params._dummy(), "phases", "one per direction", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="fourier", waves=None, phases=None):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="fourier")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        phases = np.array(self.getOrDefault(self.phases))
        waves = np.array(self.getOrDefault(self.waves)).reshape(len(phases), -1)
        wide = df.withColumn("_x", vector_to_array(F.col(self.getInputCol())))
        xs = [F.col("_x")[i] for i in range(waves.shape[1])]
        return wide.withColumn(self.getOutputCol(), array_to_vector(F.array(*fourier_columns(xs, waves, phases)))).drop("_x")


class SupportVectorClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Binary support vector classifier with penalty ``C``, ``kernel`` "linear" or "rbf"."""

    C = Param(Params._dummy(), "C", "weight of the losses", typeConverter=TypeConverters.toFloat)
    kernel = Param(Params._dummy(), "kernel", "linear or rbf", typeConverter=TypeConverters.toString)
    gamma = Param(Params._dummy(), "gamma", "kernel width; 0 = by the data's variance", typeConverter=TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "number of random features for rbf", typeConverter=TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "solver rounds", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", C=1.0, kernel="rbf", gamma=0.0, size=64, maxIter=50, seed=1):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", C=1.0, kernel="rbf", gamma=0.0, size=64, maxIter=50, seed=1)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> Transformer:
        features, stages = self.getFeaturesCol(), []
        if self.getOrDefault(self.kernel) == "rbf":
            stages.append(FourierFeatures(inputCol=features, outputCol="_fourier", gamma=self.getOrDefault(self.gamma), size=self.getOrDefault(self.size), seed=self.getSeed()))
            features = "_fourier"
        weight = 1.0 / (self.getOrDefault(self.C) * max(1, df.count()))
        svc = LinearSVC(featuresCol=features, labelCol=self.getLabelCol(), regParam=weight, standardization=False, maxIter=self.getOrDefault(self.maxIter))
        return Pipeline(stages=[*stages, svc]).fit(df)


@dataclass
class MarginOneVsRest:
    """Binary classifiers with a raw score, one per class; the class of the largest score wins (the first on ties)."""

    classes: list
    models: list

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``scores`` (array by class) and ``prediction``."""
        scored, raw = df, []
        for k, model in enumerate(self.models):
            scored = model.transform(scored).withColumn(f"_margin{k}", vector_to_array("rawPrediction")[1])
            scored = scored.select(*df.columns, *raw, f"_margin{k}")
            raw.append(f"_margin{k}")
        out = scored.withColumn("scores", F.array(*raw)).drop(*raw)
        best = F.array_position("scores", F.array_max("scores")).cast("int")
        return out.withColumn("prediction", F.element_at(F.array(*[F.lit(c) for c in self.classes]), best))


def margin_one_vs_rest(df: DataFrame, classifier: Estimator, label: str = "label") -> MarginOneVsRest:
    """Fit a binary classifier without probabilities (support vectors) against the rest of each class."""
    classes = sorted(r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().collect())
    models = []
    for c in classes:
        own = df.withColumn("_own", (F.col(label) == F.lit(c)).cast("double"))
        models.append(classifier.copy({classifier.labelCol: "_own"}).fit(own))
    return MarginOneVsRest(classes, models)


# ---- stumps ---------------------------------------------------------------------------


def split_scores(df: DataFrame, features: list[str], label: str, classes: list) -> DataFrame:
    """(feature, threshold, gini): weighted Gini index of every split ``x <= threshold``.

    Rows are counted per feature value first; prefix sums over the values give
    both sides of every split.
    """
    long = df.select(
        F.col(label).alias("_y"), F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("threshold")) for f in features]))
    )
    counts = long.groupBy("feature", "threshold").agg(*[F.count_if(F.col("_y") == c).alias(f"_c{i}") for i, c in enumerate(classes)])
    sums = {f"s{i}": F.col(f"_c{i}") for i in range(len(classes))}
    sides = running_totals(counts, ["threshold"], sums, by=["feature"], with_total=True)
    left = [F.col(f"s{i}") for i in range(len(classes))]
    right = [F.col(f"s{i}_total") - F.col(f"s{i}") for i in range(len(classes))]

    def spread(parts):
        n = sum(parts[1:], parts[0])
        squares = sum([p * p for p in parts[1:]], parts[0] * parts[0])
        return F.when(n == 0, F.lit(0.0)).otherwise(n - squares / n), n

    (a, na), (b, nb) = spread(left), spread(right)
    return sides.where(nb > 0).select("feature", "threshold", ((a + b) / (na + nb)).alias("gini"))


def best_split(df: DataFrame, features: list[str], label: str, classes: list) -> DataFrame:
    """The split of lowest impurity: a tree of depth one."""
    return split_scores(df, features, label, classes).orderBy("gini", "feature", "threshold").limit(1)


def assembled(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)
