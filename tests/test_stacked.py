"""Stacked logistic regressions against single fits, bootstraps against their weights, and odd rows."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from loomstat.operators import columns, stacked

XS = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 2)) * [1.0, 50.0]
    y = np.digitize(x[:, 0] + x[:, 1] / 50 + rng.normal(size=600), [-0.8, 0.8]).astype(float)
    return spark.createDataFrame([(i, float(a), float(b), float(c), i % 4) for i, ((a, b), c) in enumerate(zip(x, y))], "id bigint, a double, b double, label double, fold int").cache()


def single(rows, positive, l2, weight=None):
    own = columns.to_features(rows.withColumn("own", (F.col("label") == positive).cast("double")), XS)
    lr = LogisticRegression(labelCol="own", regParam=l2, standardization=False, tol=1e-12, maxIter=500)
    model = (lr.setWeightCol(weight) if weight else lr).fit(own)
    return [model.intercept, *model.coefficients.toArray()]


def test_equals_single_fits(spark, rows):
    members = [stacked.Member(positive=c, l2=p, fold=k) for c in (0.0, 2.0) for p in (0.0, 0.1) for k in (None, 1)]
    fit = stacked.stacked_logistic(rows, "id", XS, "label", members, fold="fold")
    assert fit.settled.all() and fit.passes < 20
    for m, w in zip(members, fit.weights):
        some = rows if m.fold is None else rows.where(F.col("fold") != m.fold)
        assert w == pytest.approx(single(some, m.positive, m.l2), rel=2e-4, abs=2e-5)


def test_bootstraps_equal_weighted_fits(spark, rows):
    fit = stacked.stacked_logistic(rows, "id", XS, "label", [stacked.Member(draw=k) for k in (0, 7)], seed=3)
    h = rows.select("id", F.xxhash64(F.lit(3), "id").alias("h")).collect()
    w = stacked.draws(np.array([r.h for r in h], np.int64).view(np.uint64), np.array([0, 7]), 1.0)
    assert w.mean() == pytest.approx(1.0, abs=0.1) and w.var() == pytest.approx(1.0, abs=0.2) and (w[:, 0] != w[:, 1]).mean() > 0.4
    for k in (0, 1):
        table = rows.join(spark.createDataFrame([(r.id, float(v)) for r, v in zip(h, w[:, k])], "id bigint, w double"), "id")
        assert fit.weights[k] == pytest.approx(single(table, 1.0, 0.0, "w"), rel=2e-4, abs=2e-5)


def test_balance_and_path(spark, rows):
    fit = stacked.stacked_logistic(rows, "id", XS, "label", [stacked.Member(positive=c, l2=p) for p in (1e-3, 1e3) for c in (0.0, 1.0, 2.0)])
    got = {(r.l2, r["class"], r.feature): r.balance for r in stacked.balances(rows, XS, fit).collect()}
    for c in (0.0, 1.0, 2.0):
        own = (F.col("label") == c).cast("double")
        share = rows.agg(F.avg(own).alias("bias"), *[F.avg(own * F.col(x)).alias(x) for x in XS]).first()
        assert all(got[p, c, f] == pytest.approx(share[f], abs=1e-5) for p in (1e-3, 1e3) for f in ("bias", *XS))
    path = stacked.one_vs_rest_path(rows, "id", XS, "label", [0.0, 1.0, 2.0], [1e-3, 1.0, 1e3]).where("feature <> 'bias'")
    sizes = {r.l2: r.s for r in path.groupBy("l2").agg(F.sum(F.abs("weight")).alias("s")).collect()}
    assert path.count() == 18 and sizes[1e-3] > sizes[1.0] > sizes[1e3]


def test_scores_and_probabilities(spark, rows):
    two = rows.where("label <> 1").withColumn("label", (F.col("label") == 2).cast("double"))
    scores = stacked.penalty_scores(two, "id", XS, "label", "fold", 4, [0.01, 0.1])
    assert scores.count() == 8 and scores.agg(F.min("valid")).first()[0] > 0.75
    fit = stacked.stacked_logistic(two, "id", XS, "label", [stacked.Member(), stacked.Member(l2=1.0)])
    for r in fit.probabilities(two, XS).limit(20).collect():
        want = np.mean([1 / (1 + math.exp(-(w[0] + w[1] * r.a + w[2] * r.b))) for w in fit.weights])
        assert r.p == pytest.approx(want)


def test_odd_rows(spark, rows):
    odd = rows.unionByName(spark.createDataFrame([(900, None, 1.0, 1.0, 0), (901, 1.0, math.nan, 1.0, 0), (902, 1.0, 1.0, None, 0), (903, 1.0, 1.0, 1.0, None)], rows.schema))
    members = [stacked.Member(l2=0.1, fold=2)]
    assert stacked.stacked_logistic(odd, "id", XS, "label", members, "fold").weights == pytest.approx(stacked.stacked_logistic(rows, "id", XS, "label", members, "fold").weights)
    assert stacked.stacked_logistic(rows.limit(0), "id", XS, "label", members).weights.tolist() == [[0.0, 0.0, 0.0]]
    flat = stacked.stacked_logistic(rows.withColumn("a", F.lit(0.0)), "id", XS, "label", members)
    assert flat.settled.all() and flat.weights[0][1] == 0.0


def test_bootstraps_start_near_their_end(spark, rows):
    """Bags start at the settled plain fit, so few passes weigh rows member by member; rows lie on all cores."""
    from loomstat.operators.batches import evened

    rows = rows.crossJoin(spark.range(40).withColumnRenamed("id", "copy")).withColumn("id", F.col("id") * 40 + F.col("copy")).drop("copy")
    members = [stacked.Member(draw=k) for k in range(70)] + [stacked.Member(positive=2.0, l2=0.1, fold=1, draw=3), stacked.Member(positive=2.0, l2=0.1, fold=1)]
    fit = stacked.stacked_logistic(rows, "id", XS, "label", members, "fold", tol=1e-6)
    assert fit.settled.all()
    assert fit.passes <= 4
    alone = stacked.stacked_logistic(rows, "id", XS, "label", members[-2:-1], "fold", tol=1e-9)
    assert fit.weights[-2] == pytest.approx(alone.weights[0], rel=1e-4, abs=1e-5)
    assert evened(rows).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


def test_draws_equal_the_distribution_function():
    from loomstat.functions.hashing import poisson_thresholds

    h, numbers = np.random.default_rng(3).integers(0, 2**63, 3000).astype(np.uint64), np.arange(5)
    for mean in (0.3, 1.0, 4.0):
        salt = stacked._mixed((numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        u = (stacked._mixed(h[:, None] ^ salt[None, :]) >> np.uint64(11)).astype(np.float64) / 2.0**53
        assert (stacked.draws(h, numbers, mean) == np.searchsorted(np.array(poisson_thresholds(mean)), u, side="right")).all()
