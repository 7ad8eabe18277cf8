"""Properties that must hold whatever the data, the partitions and the block sizes."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from loomstat.functions.hashing import hash52, uniform, uniform_below
from loomstat.operators import classify, cluster, columns, decompose, encode, ensemble, joins, linear, linkage, metrics, neighbors, ordering, sampling, select, stats

RNG = np.random.default_rng(5)
N = 400


@pytest.fixture(scope="module")
def frame():
    x = RNG.normal(size=(N, 3))
    y = x @ [1.5, -2.0, 0.0] + 0.3 * RNG.normal(size=N)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(
        id=np.arange(N), y=y, label=(y + 0.5 * RNG.normal(size=N) > 0).astype(int), g=np.where(np.arange(N) % 3 == 0, "hot", (np.arange(N) % 7).astype(str)),
        score=np.round(y, 1),
    )
    return pdf


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).repartition(5).persist()


@pytest.mark.parametrize("parts", [1, 8])
def test_order_does_not_depend_on_partitions(df, frame, parts):
    rows = df.repartition(parts)
    want = frame.sort_values(["score", "id"]).reset_index(drop=True)
    ranked = ordering.ordered_rank(rows, ["score", "id"], "rn", with_total=True).toPandas().sort_values("rn")
    assert ranked["id"].tolist() == want["id"].tolist() and set(ranked["rn_total"]) == {N}
    sums = ordering.running_totals(rows, ["score", "id"], {"s": F.col("y")}, by=["g"]).toPandas()
    expected = want.assign(s=want.groupby("g")["y"].cumsum()).set_index("id")["s"]
    assert np.allclose(sums.set_index("id")["s"].loc[expected.index], expected)
    prev = ordering.previous_values(rows, ["score", "id"], ["id"], by=["g"]).toPandas().set_index("id")["prev_id"]
    shifted = want.assign(p=want.groupby("g")["id"].shift()).set_index("id")["p"]
    assert prev.loc[shifted.index].fillna(-1).tolist() == shifted.fillna(-1).tolist()


def test_order_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # no merging of small ranges
    try:
        rows = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("v"))
        got = ordering.running_totals(rows, ["v"], {"s": F.col("v")}).orderBy("v").toPandas()
        assert got["s"].tolist() == np.arange(1000).cumsum().tolist()
        prev = ordering.previous_values(rows, ["v"], ["v"]).orderBy("v").toPandas()["prev_v"]
        assert prev[1:].astype(int).tolist() == list(range(999)) and pd.isna(prev[0])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_totals_of_any_kind_over_small_batches(spark):
    """NULL and NaN groups, NULL values, decimals, vectors beside them, batches smaller than groups, falling order."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(names[0], "7")
    spark.conf.set(names[1], "false")
    try:
        rows = spark.range(300).selectExpr(
            "id",
            "CASE WHEN id % 10 < 6 THEN 'hot' WHEN id % 10 < 9 THEN concat('g', id % 40) END AS g",
            "CASE WHEN id % 4 > 0 THEN id / 3 END AS v",
            "CAST(id % 7 AS decimal(5, 2)) AS d",
            "CASE WHEN id % 3 = 0 THEN double('NaN') WHEN id % 3 = 1 THEN 1.0D END AS h",
        ).withColumn("vec", array_to_vector(F.array(F.col("id").cast("double"))))
        totals = {"s": F.col("v"), "t": F.col("d"), "n": F.lit(1).cast("bigint")}
        out = ordering.running_totals(rows, [F.desc("id")], totals, by=["g"], with_total=True)
        assert out.schema["t"].dataType.simpleString() == "decimal(15,2)"
        got = sorted((row.asDict() for row in out.collect()), key=lambda row: -row["id"])
        seen = {}
        for row in got:
            before = seen.setdefault(row["g"], [])
            before.append(row)
            known = [x["v"] for x in before if x["v"] is not None]
            assert row["s"] == (pytest.approx(sum(known)) if known else None)
            assert row["n"] == len(before) and row["t"] == sum(x["d"] for x in before)
        assert len(got) == 300 and all(row["n_total"] == len(seen[row["g"]]) for row in got)
        prev = ordering.previous_values(rows, ["id"], ["id", "vec"], by=["h"])
        assert prev.where("prev_id = id - 3").count() == 297 and prev.where("prev_vec IS NULL").count() == 3
        assert ordering.ordered_rank(rows.limit(0), ["id"], with_total=True).count() == 0
    finally:
        for name in names:
            spark.conf.unset(name)


def test_ranked_rows_are_not_exchanged_again(spark):
    plan = ordering.ordered_rank(spark.range(100).selectExpr("id", "id % 3 AS wide"), ["id"], by=["wide"])._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_null_groups_are_kept(spark):
    rows = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(20)], "id int, g string")
    ranked = ordering.ordered_rank(rows, ["id"], "rn", by=["g"]).orderBy("id").toPandas()
    assert ranked["rn"].tolist() == [i // 2 + 1 for i in range(20)]
    assert ordering.previous_values(rows, ["id"], ["id"], by=["g"]).where("prev_id = id - 2").count() == 18
    split = sampling.stratified_split(rows, "id", "g", 0.5, seed=1)
    assert split.count() == 20 and split.where("is_test").count() == 10


def test_hashes(spark):
    u = spark.range(4000).select(uniform(3, "id").alias("u"), uniform_below(3, 0.3, "id").alias("b"))
    assert u.where((F.col("u") < 0.3) != F.col("b")).count() == 0
    low, high, mean = u.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < high < 1 and abs(mean - 0.5) < 0.02


def test_splits_and_folds(df, frame):
    split = sampling.stratified_split(df, "id", "g", 0.3, seed=1)
    shares = split.groupBy("g").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()
    assert all(r.t == int(0.3 * r.n) for r in shares) and sum(r.n for r in shares) == N
    assert split.select("id").distinct().count() == N
    again = sampling.stratified_split(df.repartition(1), "id", "g", 0.3, seed=1)
    assert split.select("id", "is_test").exceptAll(again.select("id", "is_test")).count() == 0
    folds = sampling.stratified_folds(df, "id", "g", 4, seed=2)
    sizes = folds.groupBy("g", "fold").count().groupBy("g").agg((F.max("count") - F.min("count")).alias("d")).collect()
    assert all(r.d <= 1 for r in sizes)


def test_top_k_of_a_hot_group(df, frame):
    got = stats.top_k(df.select("g", "id", "score"), ["g"], [F.desc("score"), F.asc("id")], 3).toPandas()
    want = frame.sort_values(["score", "id"], ascending=[False, True]).groupby("g").head(3)
    assert sorted(zip(got["g"], got["id"])) == sorted(zip(want["g"], want["id"]))


def test_salted_join_equals_plain_join(df):
    lookup = df.groupBy("g").agg(F.count("*").alias("n"), F.avg("y").alias("m"))
    salted = joins.salted_join(df.select("id", "g"), lookup, "g", "id", "n", pieces=20).select("id", "g", "m")
    plain = df.select("id", "g").join(lookup, "g").select("id", "g", "m")
    assert salted.count() == N and salted.exceptAll(plain).count() == 0


def test_lasso_and_elastic_net_conditions(df, frame):
    g = linear.gram(df, ["a", "b", "c"], "y")
    x, y = frame[["a", "b", "c"]].to_numpy(), frame["y"].to_numpy()
    for alpha, ratio in ((0.1, 1.0), (0.4, 0.5)):
        fit = linear.elastic_net(g, alpha, ratio)
        slope = x.T @ (y - fit.b - x @ fit.w) / N - alpha * (1 - ratio) * fit.w
        for s, w in zip(slope, fit.w):
            assert abs(s) <= alpha * ratio + 1e-8
            if w:
                assert s == pytest.approx(np.sign(w) * alpha * ratio, abs=1e-8)
    ml = LinearRegression(regParam=0.1, elasticNetParam=1.0, standardization=False, solver="l-bfgs", tol=1e-10, maxIter=500, labelCol="y").fit(
        columns.to_features(df, ["a", "b", "c"])
    )
    assert np.allclose(linear.lasso(g, 0.1).w, ml.coefficients.toArray(), atol=1e-5)


def test_gram_scores_equal_scores_of_rows(df):
    g = linear.gram(df, ["a", "b"], "y")
    fit = linear.lasso(g, 0.2)
    rows = metrics.regression_scores(df.withColumn("p", fit.score(["a", "b"])), "y", "p").first()
    assert g.scores(fit) == {"mse": pytest.approx(rows.mse), "r2": pytest.approx(rows.r2)}


def test_descent_approaches_least_squares(df):
    g = linear.gram(df, ["a", "b", "c"], "y")
    best, fit = g.least_squares(), linear.gradient_descent(g, 0.1, 200)
    assert np.allclose(fit.w, best.w, atol=1e-6) and all(a >= b - 1e-12 for a, b in zip(fit.losses, fit.losses[1:]))
    batches = linear.hashed_batches(df, "id", ["a", "b", "c"], "y", 8, seed=1)
    assert sum(b.n for b in batches) == N
    assert np.allclose(linear.minibatch_descent(batches, 0.02, 200).w, best.w, atol=0.05)


def test_ransac_ignores_outliers(spark):
    rows = [(i, float(i % 50), 3.0 * (i % 50) + 1 + (500.0 if i % 10 == 0 else 0.0)) for i in range(500)]
    found = linear.ransac(spark.createDataFrame(rows, "id bigint, x double, y double"), "id", "x", "y", 30, 0.02, 5.0, seed=3)
    assert found.fit.w[0] == pytest.approx(3.0) and found.inliers == 450


def test_trials_are_fits_of_their_draws(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 2)) + [100.0, 0.0]
    y = x @ [2.0, -3.0] + 5 + rng.normal(size=400)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id bigint, a double, b double, y double").cache()
    fits = linear.trial_fits(df.unionByName(df.limit(5).withColumn("b", F.lit(None).cast("double"))), "id", ["a", "b"], "y", 12, 0.4, seed=9)
    h = np.array([r.h for r in df.select("id", hash52(9, "id").alias("h")).orderBy("id").collect()], object)
    shares = []
    for (factor, shift), fit in zip(linear.trial_turns(12), fits):
        mine = np.array([(v * factor + shift) % 2**52 < 0.4 * 2**52 for v in h])
        shares.append(mine)
        want = np.linalg.lstsq(np.column_stack([np.ones(mine.sum()), x[mine]]), y[mine], rcond=None)[0]
        assert [fit.b, *fit.w] == pytest.approx(want.tolist(), rel=1e-6)
    assert all(0.3 < s.mean() < 0.5 for s in shares) and all(0.35 < (a != b).mean() < 0.6 for a, b in zip(shares, shares[1:]))
    counts = linear.inlier_counts(df, ["a", "b"], "y", [*fits, None], 1.5)
    assert counts[-1] == 0 and counts[0] == int((np.abs(y - fits[0].b - x @ fits[0].w) <= 1.5).sum())
    found = linear.ransac(df, "id", ["a", "b"], "y", 12, 0.4, 1.5, seed=9)
    assert found.inliers == max(counts) and df.where(found.inlier(["a", "b"], "y")).count() == found.inliers
    flat = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 4.0)], "id bigint, x double, y double")
    assert linear.trial_fits(flat, "id", "x", "y", 3, 1.0, seed=1) == [None] * 3


def test_perceptron_separates(spark):
    rows = [(i, float(x), float(y), int(x + y > 0)) for i, (x, y) in enumerate(RNG.normal(size=(600, 2)) * 3) if abs(x + y) > 0.5]
    df = spark.createDataFrame(rows, "id bigint, x double, y double, label int")
    fit = classify.perceptron(df, "id", ["x", "y"], "label", num_iter=15, shards=4)
    wrong = df.where(fit.predict(F.array("x", "y")) != F.col("label")).count()
    assert wrong <= 0.03 * len(rows) and fit.losses[-1] <= fit.losses[0]


def test_logistic_probabilities_and_path(df):
    rows = columns.to_features(df, ["a", "b", "c"])
    model = classify.logistic(l2=0.1, max_iter=200).fit(rows)
    w, b = model.coefficients.toArray(), model.intercept
    pdf = df.select("a", "b", "c", "label").toPandas()
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf["label"].to_numpy()
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.allclose(x.T @ (p - y) / len(y) + 0.1 * w, 0, atol=1e-4) and abs((p - y).mean()) < 1e-4
    path = classify.regularisation_path(rows, [1e-3, 1.0, 1e3], ["a", "b", "c"]).groupBy("l2").agg(F.sum(F.abs("weight")).alias("s"))
    sizes = [r.s for r in path.orderBy("l2").collect()]
    assert sizes[0] > sizes[1] > sizes[2]


def test_one_vs_rest_sums_to_one(df):
    rows = columns.to_features(df.withColumn("cls", F.pmod("id", F.lit(3)).cast("double")), ["a", "b"])
    model = classify.one_vs_rest(classify.logistic(label="cls"), label="cls").fit(rows)
    probs = classify.one_vs_rest_probabilities(model, rows).select("probs").toPandas()["probs"]
    assert all(abs(sum(p) - 1) < 1e-9 and len(p) == 3 for p in probs)


def brute_nearest(train, queries, k):
    out = {}
    for qid, q in queries:
        out[qid] = [i for _, i in sorted((float(((np.array(q) - np.array(t)) ** 2).sum()), i) for i, t in train)[:k]]
    return out


@pytest.mark.parametrize("pivots,block", [(64, 4096), (8, 16), (1, 7)])
def test_nearest_equals_brute_force(spark, pivots, block):
    # A grid gives many ties; a third of the rows sit on one point.
    pts = [(i, [float(v) for v in (RNG.integers(0, 6, 2) if i % 3 else (2, 2))]) for i in range(300)]
    train, queries = pts[:200], pts[200:]
    frame = lambda rows: spark.createDataFrame([(i, v, i % 4) for i, v in rows], "id bigint, vec array<double>, label int")
    got = neighbors.nearest(frame(train), frame(queries), "id", "vec", "label", k=5, pivots=pivots, block=block)
    found = got.orderBy("query", "rank").toPandas().groupby("query")["neighbour"].apply(list).to_dict()
    assert found == brute_nearest(train, queries, 5)


@pytest.mark.parametrize("block", [4096, 11])
def test_silhouette_equals_brute_force(spark, block):
    x = RNG.normal(size=(60, 2))
    c = [0 if i < 25 else 1 if i < 59 else 2 for i in range(60)]
    rows = spark.createDataFrame([(i, [float(v) for v in p], k) for i, (p, k) in enumerate(zip(x, c))], "id bigint, vec array<double>, cluster int")
    got = {r.id: r.silhouette for r in cluster.silhouette(rows, "id", "vec", "cluster", block).collect()}
    squared = {r.id: r.silhouette for r in cluster.silhouette_squared(rows, "id", "vec", "cluster", 2).collect()}
    for power, values in ((1, got), (2, squared)):
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
        for i in range(60):
            own = [j for j in range(60) if c[j] == c[i] and j != i]
            if not own:
                assert values[i] == 0
                continue
            a, b = d[i, own].mean(), min(d[i, [j for j in range(60) if c[j] == k]].mean() for k in set(c) - {c[i]})
            assert values[i] == pytest.approx((b - a) / max(a, b))


def test_kmeans_labels_and_inertia(df, frame):
    rows = df.select("id", F.array("a", "b").alias("vec"))
    fit = cluster.kmeans(rows, "id", "vec", 3, n_init=4, max_iter=50)
    x = frame[["a", "b"]].to_numpy()
    d2 = ((x[:, None] - fit.centres[None]) ** 2).sum(-1)
    assert fit.inertia == pytest.approx(d2.min(axis=1).sum()) and fit.sizes.tolist() == np.bincount(d2.argmin(axis=1)).tolist()
    curve = [r.inertia for r in cluster.elbow(rows, "id", "vec", range(1, 6), n_init=4).orderBy("k").collect()]
    assert curve[0] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum()) and all(a >= b for a, b in zip(curve, curve[1:]))


def test_agglomerate(df):
    placed, merges = cluster.agglomerate(columns.to_features(df, ["a", "b"]), 3, micro=12)
    assert placed.select("cluster").distinct().count() == 3 and placed.count() == N
    assert merges.count() == 11


def plain_linkage(x):
    """Merges (smaller item, other group's smallest item, distance), one by one."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    out = []
    for _ in range(len(x) - 1):
        i, j = sorted(divmod(int(d.argmin()), len(x)))
        out.append((i, j, d[i, j]))
        d[i] = d[:, i] = np.maximum(d[i], d[j])
        d[i, i] = np.inf
        d[j] = d[:, j] = np.inf
    return out


@pytest.mark.parametrize("n,width,finish", [(500, 3, 40), (20, 1, 0), (1, 2, 64), (2, 2, 0)])
def test_complete_linkage_equals_single_merges(spark, n, width, finish):
    x = np.random.default_rng(n).normal(size=(n, width))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(n + 5, None)], "id bigint, vec array<double>")
    merges = linkage.complete_linkage(linkage.pair_distances(items, "id", "vec", block=200), finish)
    got = sorted((m.a, m.b, round(m.distance, 9)) for m in merges.collect())
    assert got == sorted((a, b, round(float(d), 9)) for a, b, d in plain_linkage(x))


def test_complete_linkage_with_ties_and_copies(spark):
    x = [[float(i // 3), float(i % 2)] for i in range(40)]
    items = spark.createDataFrame(list(enumerate(x)), "id bigint, vec array<double>")
    tree = linkage.merge_tree(items, "id", "vec").orderBy("step").collect()
    assert len(tree) == 39 and all(a.distance <= b.distance for a, b in zip(tree, tree[1:]))
    members = {i: [i] for i in range(40)}
    for t in tree:  # each merge's distance is that of its farthest members
        one, two = members.pop(t.left), members.pop(t.right)
        members[40 + t.step] = one + two
        assert t.distance == pytest.approx(max(math.dist(x[i], x[j]) for i in one for j in two))
    assert linkage.complete_linkage(linkage.pair_distances(items.limit(0), "id", "vec")).collect() == []


def test_components(df):
    found = decompose.components(df, ["a", "b", "c"])
    v = found.vectors
    assert np.allclose(v.T @ v, np.eye(3)) and np.all(np.diff(found.values) <= 1e-12)
    spread = df.agg(*[F.var_samp(c) for c in "abc"]).first()
    assert found.values.sum() == pytest.approx(sum(spread))
    scores = found.project(df, ["a", "b", "c"], 2)
    assert scores.agg(F.var_samp("pc0")).first()[0] == pytest.approx(found.values[0])
    z = encode.standardised(df.select("a", "b", "c"), ["a", "b", "c"])
    scaled = decompose.components(z, ["a", "b", "c"])
    loading = scaled.project(z, ["a", "b", "c"], 1).agg(F.corr("a", "pc0")).first()[0]
    assert loading == pytest.approx(scaled.loadings()[0, 0])


def test_forests(df):
    rows = columns.to_features(df, ["a", "b", "c"]).withColumn("label", F.col("label").cast("double"))
    forest = ensemble.random_forest(10, max_depth=4).fit(rows)
    assert sum(r.importance for r in ensemble.importances(forest, ["a", "b", "c"]).collect()) == pytest.approx(1.0)
    tree = ensemble.decision_tree(max_depth=3).fit(rows)
    single = ensemble.bagged_trees(1, bootstrap=False, max_depth=3).fit(rows)
    a, b = (ensemble.class_probabilities(m, rows, "id").toPandas().set_index("id")["p"].sort_index() for m in (tree, single))
    assert np.allclose(np.vstack(a), np.vstack(b)) and np.allclose(np.vstack(a).sum(axis=1), 1)


def test_boosting_lowers_the_training_error(df):
    rows = columns.to_features(df, ["a", "b", "c"]).withColumn("label", F.col("label").cast("double"))
    accuracy = lambda m: m.transform(rows).agg(metrics.accuracy("label", "prediction")).first()[0]
    one = ensemble.adaboost(rows, ensemble.decision_tree(max_depth=1), 1)
    many = ensemble.adaboost(rows, ensemble.decision_tree(max_depth=1), 12, checkpoint_every=4)
    assert accuracy(many) >= accuracy(one) and len(many.members) > 1


def test_soft_vote_and_bag(df):
    from pyspark.ml.classification import LogisticRegression

    rows = columns.to_features(df, ["a", "b", "c"]).withColumn("label", F.col("label").cast("double"))
    models = ensemble.bag(rows, LogisticRegression(), "id", members=3, seed=1)
    voted = ensemble.soft_vote([ensemble.class_probabilities(m, rows, "id") for m in models], "id", 2)
    assert voted.count() == N and voted.where(F.abs(F.col("p")[0] + F.col("p")[1] - 1) > 1e-9).count() == 0


def test_roc_against_definitions(df, frame):
    auc = metrics.roc_auc(df, "label", "score").first().auc
    pos, neg = frame.loc[frame.label == 1, "score"].to_numpy(), frame.loc[frame.label == 0, "score"].to_numpy()
    wins = (pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean()
    assert auc == pytest.approx(wins)
    curve = metrics.roc_curve(df, "label", "score")
    assert metrics.curve_area(curve, "fpr", "tpr").first().auc == pytest.approx(wins)
    pts = curve.orderBy("fpr", "tpr").toPandas()
    grid = [i / 19 for i in range(20)]
    got = metrics.interpolated(curve.withColumn("f", F.lit(1)), "fpr", "tpr", grid, ["f"]).orderBy("grid_id").toPandas()["tpr"]
    for g, value in zip(grid, got):
        at = int(np.searchsorted(pts["fpr"], g))
        want = pts["tpr"][0] if at == 0 else np.interp(g, pts["fpr"][at - 1 : at + 1], pts["tpr"][at - 1 : at + 1])
        assert value == pytest.approx(want)


def test_interpolation_is_clamped(spark):
    curve = spark.createDataFrame([(1, 2.0, 10.0), (1, 4.0, 20.0)], "f int, x double, y double")
    got = metrics.interpolated(curve, "x", "y", [0.0, 2.0, 3.0, 4.0, 9.0], ["f"]).orderBy("grid_id").collect()
    assert [r.y for r in got] == [10.0, 10.0, 15.0, 20.0, 20.0]


def test_one_class_and_empty_margins(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "label int, prediction int")
    row = metrics.binary_scores(df, "label", "prediction").first()
    assert (row.precision, row.recall, row.f1, row.mcc) == (1.0, 1.0, 1.0, 0.0)
    assert metrics.confusion_counts(df, "label", "prediction").collect()[0].n == 2


def test_constant_column_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    low = encode.fit_min_max_scaler(df, ["a", "b"]).transform(df).orderBy("a").collect()
    assert [tuple(r) for r in low] == [(0.0, 0.5), (1.0, 0.5)]
    std = encode.fit_standard_scaler(df, ["a", "b"])
    assert [r.b for r in std.transform(df).collect()] == [0.0, 0.0]
    assert [tuple(r) for r in std.inverse(std.transform(df)).orderBy("a").collect()] == [(1.0, 5.0), (3.0, 5.0)]


def test_support_vectors_learn_a_circle(spark):
    pts = RNG.normal(size=(600, 2)) * 1.5
    rows = spark.createDataFrame([(float(x), float(y), float(x * x + y * y > 3)) for x, y in pts], "x double, y double, label double")
    data = columns.to_features(rows.coalesce(1), ["x", "y"]).persist()
    score = lambda kernel: classify.SupportVectorClassifier(kernel=kernel, C=10.0, size=100, maxIter=20).fit(data).transform(data).agg(metrics.accuracy("label", "prediction")).first()[0]
    assert score("rbf") > 0.9 > score("linear")


def test_searches(df):
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import ParamGridBuilder

    rows = columns.to_features(sampling.stratified_folds(df.select("id", "label", "a", "b"), "id", "label", 3, seed=1), ["a", "b"])
    rows = rows.withColumn("label", F.col("label").cast("double"))
    lr = classify.logistic()
    grids = [ParamGridBuilder().addGrid(lr.regParam, [0.01, 100.0]).build(), ParamGridBuilder().addGrid(lr.regParam, [1.0]).build()]
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
    found = select.grid_search(rows, Pipeline(stages=[lr]), grids, evaluator, "fold", 3)
    assert found.table.count() == 3 and found.best_score == pytest.approx(max(r["mean"] for r in found.table.collect()))
    drawn = select.random_search(rows, Pipeline(stages=[lr]), grids, evaluator, "fold", 3, n_iter=2, seed=1)
    assert drawn.table.count() == 2
    acc = lambda scored: scored.agg(metrics.accuracy("label", "prediction")).first()[0]
    scores = select.fold_scores(rows, {"lr": lr}, "fold", 3, acc)
    assert scores.count() == 3 and scores.where("valid between 0 and 1").count() == 3


def test_topics_are_shares(spark):
    from loomstat.operators import vectorize

    docs = spark.createDataFrame([(i, ["sun", "sea"] * 5 if i % 2 else ["tax", "law"] * 5) for i in range(40)], "id bigint, tokens array<string>")
    vocab = vectorize.vocabulary(vectorize.term_totals(docs, F.col("tokens")))
    counted = vectorize.count_vectorizer(vocab, "tokens", "features").transform(docs)
    model = decompose.fit_topics(counted, 2, max_iter=20)
    shares = model.transform(counted).select(vector_to_array("topicDistribution").alias("t")).toPandas()["t"]
    assert all(abs(sum(t) - 1) < 1e-6 for t in shares) and np.isfinite(model.logLikelihood(counted))
    assert decompose.top_words(model, vocab, 2).count() == 4
