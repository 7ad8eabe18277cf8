"""Ordinary data that is easily forgotten: NULLs, constants, one class, nothing at all."""

import math

import numpy as np
import pytest
from loomstat.operators import classify, cluster, columns, encode, ensemble, linear, metrics, sampling, select, stats
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

POINTS = "x double, y double"


# ---- linear models ------------------------------------------------------------


def test_rows_with_nulls_take_no_part(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 8.0), (5.0, None)], POINTS)
    g = linear.gram(df, ["x"], "y")
    fit = g.least_squares()
    assert (g.n, g.dropped) == (3, 2) and fit.w[0] == pytest.approx(2) and fit.b == pytest.approx(0, abs=1e-9)


def test_collinear_and_constant_columns(spark):
    rows = [(float(i), 2.0 * i, 7.0, 3.0 * i + 1) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    fit = linear.gram(df, ["a", "b", "c"], "y").least_squares()
    assert fit.w[2] == 0 and fit.w[0] + 2 * fit.w[1] == pytest.approx(3) and fit.b == pytest.approx(1)


def test_constant_label_and_no_rows(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(6)], POINTS)
    g = linear.gram(df, ["x"], "y")
    assert g.scores(g.least_squares())["r2"] == 1.0
    empty = linear.gram(df.limit(0), ["x"], "y")
    fit = empty.least_squares()
    assert (fit.b, fit.w.tolist(), empty.n) == (0.0, [0.0], 0)
    assert linear.grams(df.limit(0), ["x"], "y", ["x"]) == {}


def test_fits_of_many_groups(spark):
    df = spark.range(3000).selectExpr("id % 1000 AS g", "cast(id AS double) AS x", "2 * id + id % 1000 AS y")
    fits = {r.g: r for r in linear.group_fits(df, ["x"], "y", ["g"]).collect()}
    assert len(fits) == 1000 and all(r.n == 3 and r.w[0] == pytest.approx(2) and r.b == pytest.approx(g, abs=1e-6) for g, r in fits.items())


def test_descent_on_log_loss_ignores_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0), (-1.0, 0.0), (0.5, 1.0), (None, 1.0), (2.0, None)], POINTS)
    fit = linear.logistic_descent(df, ["x"], "y", 0.5, 20)
    assert fit.losses[0] == pytest.approx(math.log(2)) and fit.losses[-1] < fit.losses[0] and fit.w[0] > 0


# ---- scaling and terms ----------------------------------------------------------


def test_constant_column_becomes_zero(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (None, None)], POINTS)
    assert [(round(r.x, 4) if r.x is not None else None, r.y) for r in encode.standardised(df, ["x", "y"]).collect()] == [(-0.7071, 0.0), (0.7071, 0.0), (None, None)]


def test_polynomial_names_do_not_clash(spark):
    df = spark.createDataFrame([(3.0, -1.0)], "a double, a_a double")
    with pytest.raises(ValueError):
        encode.with_polynomial(df, ["a"], 2)
    with pytest.raises(ValueError):
        encode.polynomial_terms(["a", "a_a"], 2)
    assert encode.with_polynomial(df.select("a"), ["a"], 2).first().a_a == 9.0


# ---- metrics ----------------------------------------------------------------------


def scored(spark, rows):
    return spark.createDataFrame(rows, "g string, label int, s double")


def test_one_class_has_no_curve(spark):
    df = scored(spark, [("one", 1, 0.2), ("one", 1, 0.7), ("two", 1, 0.9), ("two", 0, 0.1)])
    assert {r.g: r.auc for r in metrics.roc_auc(df, "label", "s", ["g"]).collect()} == {"one": None, "two": 1.0}
    assert all(r.fpr is None for r in metrics.roc_curve(df, "label", "s", ["g"]).where("g = 'one' and threshold is not null").collect())
    assert max(r.tpr for r in metrics.mean_roc(df, "label", "s", "g", 5).collect()) == 1.0
    assert metrics.mean_roc_area(df, "label", "s", "g", 5).first().mean_auc is not None


def test_absent_class(spark):
    df = spark.createDataFrame([(0, [0.8, 0.1, 0.1]), (1, [0.2, 0.7, 0.1]), (0, [0.6, 0.3, 0.1])], "label int, p array<double>")
    assert metrics.multiclass_auc(df, "label", "p", 3).first().auc == 1.0


def test_regression_scores_on_odd_labels(spark):
    df = spark.createDataFrame([("c", 2.0, 2.0), ("c", 2.0, 2.0), ("d", 2.0, 3.0), ("d", 2.0, 2.0), ("d", None, 9.0), ("d", 1e9, None)], "g string, y double, p double")
    got = {r.g: (r.n, r.r2) for r in metrics.regression_scores(df, "y", "p", ["g"]).collect()}
    assert got == {"c": (2, 1.0), "d": (2, 0.0)}


# ---- votes, sums, boosting ------------------------------------------------------------


def test_votes_may_be_strings(spark):
    df = spark.createDataFrame([(1, "b", 0.5), (1, "a", 0.5), (2, "z", 0.1), (2, "y", 0.3)], "k int, v string, w double")
    assert {r.k: (r.v, r.weight) for r in stats.weighted_vote(df, "k", "v", "w").collect()} == {1: ("a", 0.5), 2: ("y", 0.3)}


def test_zero_sum(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0)], POINTS)
    assert [r.n for r in stats.normalised(df, "x", "n").collect()] == [None, None]


def test_a_perfect_round(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (0, 0, 0.5)], "y int, p int, w double")
    rows = ensemble.boosting_step(df, "y", "p", "w").collect()
    assert all(r.new_weight == pytest.approx(0.5) and math.isfinite(r.alpha) for r in rows)


def test_depths():
    assert ensemble.decision_tree(0).getMaxDepth() == 0
    assert ensemble.random_forest(3).getMaxDepth() == ensemble.GROWN_OUT


@pytest.fixture(scope="module")
def learnable(spark):
    df = spark.range(400).selectExpr("id", "cast(id % 20 AS double) AS a", "cast(id % 7 AS double) AS b", "cast(id % 20 > 9 AS double) AS label")
    return columns.to_features(df, ["a", "b"]).persist()


def test_bags_with_shares(learnable):
    models = ensemble.bag(learnable, LogisticRegression(maxIter=10), "id", 3, seed=1, max_samples=0.5, max_features=0.5)
    assert len(models) == 3
    assert all(len(ensemble.member_features(10, 0.3, False, m, 1)) == 3 for m in range(20))
    assert any(len(ensemble.member_features(10, 1.0, True, m, 1)) < 10 for m in range(5))
    voted = ensemble.soft_vote([ensemble.class_probabilities(m, learnable, "id") for m in models], "id", 2)
    assert voted.count() == 400


def test_bootstrap_share(spark):
    rows = sampling.bootstrap_weights(spark.range(2000), "id", 4, seed=3, share=0.25).groupBy("member").agg(F.sum("weight").alias("n")).collect()
    assert all(400 < r.n < 600 for r in rows)


# ---- clusters -------------------------------------------------------------------------


def test_equal_points_in_two_clusters(spark):
    rows = spark.createDataFrame([(1, [1.0, 1.0], 0), (2, [1.0, 1.0], 0), (3, [1.0, 1.0], 1), (4, [1.0, 1.0], 1)], "id int, v array<double>, cluster int")
    assert {r.silhouette for r in cluster.silhouette(rows, "id", "v", "cluster").collect()} == {0.0}
    assert {r.silhouette for r in cluster.silhouette_squared(rows, "id", "v", "cluster", 2).collect()} == {0.0}


def blobs(spark):
    """Three far groups; the smallest holds six of 3006 rows."""
    df = spark.range(3006).selectExpr("id", "CASE WHEN id < 1500 THEN 0 WHEN id < 3000 THEN 1 ELSE 2 END AS g")
    x = F.col("g") * 1000.0 + F.pmod(F.xxhash64("id"), F.lit(100)) / 100
    return df.select("id", "g", F.array(x, F.pmod(F.xxhash64("id", "g"), F.lit(100)) / 100.0).alias("v"))


def test_a_small_far_cluster_is_found(spark):
    fit = cluster.kmeans(blobs(spark), "id", "v", 3, n_init=4)
    assert sorted(fit.sizes.tolist()) == [6, 1500, 1500]


def test_starts_do_not_depend_on_partitions(spark):
    settings = [(3, "random"), (3, "k-means++"), (2, "k-means++")]
    hashed = blobs(spark).select("v", F.xxhash64("id").alias("_h"))
    one, many = (cluster.starting_points(hashed.repartition(n), settings, 5) for n in (2, 8))
    assert all(np.array_equal(a, b) for a, b in zip(one, many, strict=True))


def test_kmeans_without_rows_or_with_few(spark):
    assert len(cluster.kmeans(blobs(spark).limit(0), "id", "v", 3).centres) == 0
    same = spark.createDataFrame([(1, [2.0]), (2, [2.0])], "id int, v array<double>")
    assert cluster.kmeans(same, "id", "v", 3, n_init=1).inertia == 0.0


def test_perceptron_is_the_same_on_any_number_of_partitions(spark):
    df = spark.range(600).selectExpr("id", "cast(id % 10 AS double) - 4.5 AS a", "cast(id % 10 > 4 AS int) AS label")
    one, many = (classify.perceptron(df.repartition(n), "id", ["a"], "label", num_iter=3) for n in (1, 8))
    assert np.array_equal(one.weights, many.weights) and one.losses == many.losses


# ---- support vectors, searches ----------------------------------------------------------


def test_support_vectors_can_be_saved(learnable, tmp_path):
    model = classify.SupportVectorClassifier(size=8, maxIter=5).fit(learnable)
    model.write().overwrite().save(str(tmp_path / "svc"))
    again = PipelineModel.load(str(tmp_path / "svc"))
    pick = lambda m: [r.prediction for r in m.transform(learnable).orderBy("id").select("prediction").collect()]
    assert pick(again) == pick(model)


def test_functions_as_criteria(learnable):
    lr = LogisticRegression(maxIter=5)
    rows = learnable.withColumn("fold", (F.col("id") % 3).cast("int"))
    score = lambda out: out.agg(metrics.accuracy("label", "prediction")).first()[0]
    found = select.grid_search(rows, Pipeline(stages=[lr]), [[{lr.regParam: 0.0}, {lr.regParam: 100.0}]], score, "fold", 3)
    assert found.best_params == {"regParam": 0.0} and found.best_score > 0.9
