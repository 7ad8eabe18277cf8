"""Learner queries: classifiers, ensembles, neighbours, clusters, components, topics, search."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from loomstat.functions import text as tx
from loomstat.functions.hashing import seeded_hash, uniform_below
from loomstat.operators import boosting, classify, cluster, columns, decompose, encode, ensemble, estimators, linkage, metrics, neighbors, sampling, select, stacked, stats, vectorize, wide
from loomstat.operators.batches import evened, spread
from loomstat.operators.ordering import ordered_rank
from loomstat.plans.registry import SQL_LINES, big, lines, query, r, sql_hash, sql_round, sql_uniform
from loomstat.plans.text import documents, pruned
from loomstat.session import cut_lineage, written
from loomstat.sources.tables import table

FEATURES = ["qty", "price", "disc", "tax"]
_SQL_NOISY = f"""(SELECT *, CAST((price * (1 - disc) > 45000) <> ({sql_uniform(17, 'id')} < 0.1) AS BIGINT) AS label FROM {SQL_LINES})"""


def noisy_lines(spark, d):
    """Lines with a label that a rule sets and a tenth of which is flipped."""
    rule = F.col("price") * (1 - F.col("disc")) > 45000
    return spread(lines(spark, d)).withColumn("label", (rule != uniform_below(17, 0.1, "id")).cast("double"))


def feature_rows(spark, d, features=FEATURES):
    """(id, label, features) for Spark ML."""
    return columns.to_features(noisy_lines(spark, d).select("id", "label", *features), features).select("id", "label", "features")


def split_rows(spark, d):
    """Training and test rows of the above, stratified, written once."""
    return tuple(columns.to_features(side, FEATURES).select("label", "features") for side in _plain_split(spark, d, "label", *FEATURES))


def _plain_split(spark, d, *names):
    """Training and test rows as columns (those of ``names``, or all), stratified, written once."""
    rows = sampling.stratified_split(noisy_lines(spark, d).select("id", "label", *FEATURES), "id", "label", 0.3, seed=1)
    kept = written(rows.select(*(names or rows.columns[:-1]), "is_test"))
    return kept.where(~F.col("is_test")).drop("is_test"), kept.where("is_test").drop("is_test")


def scaler(out: str = "scaled") -> StandardScaler:
    return StandardScaler(inputCol="features", outputCol=out, withMean=True, withStd=True)


def test_scores(model, test):
    """Accuracy and ROC area of a fitted binary model on test rows."""
    scored = model.transform(test)
    auc = BinaryClassificationEvaluator(numBins=0).evaluate(scored)
    return scored.agg(F.count(F.lit(1)).alias("n"), r(metrics.accuracy("label", "prediction")).alias("accuracy"), r(F.lit(auc)).alias("auc"))


# ---- linear classifiers ----------------------------------------------------------------


def _sql_perceptron(source: str, classes: int, epochs: int, result: str, shards: int = 16, batch: int = 32) -> str:
    """Epochs of a sharded perceptron over ``source`` (id, label, FEATURES): ``a<k>`` holds weights and errors of epoch k, ``line`` the rows."""
    xs = ["1.0", *FEATURES]
    cells = [(k, j) for k in range(classes) for j in range(len(xs))]
    score = [" + ".join(f"w{k}_{j} * {x}" for j, x in enumerate(xs)) for k in range(classes)]
    guess = "CASE " + " ".join(f"WHEN {' AND '.join(f's{k} >= s{o}' for o in range(classes) if o != k)} THEN {k}" for k in range(classes)) + " END"
    scaled = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}" for c in FEATURES)
    names = ", ".join(f"w{k}_{j}" for k, j in cells)
    parts = [
        f"line AS MATERIALIZED (SELECT id, CAST(label AS INT) AS y, {sql_hash(1, 'id')} AS h, {scaled} FROM {source})",
        f"deal AS (SELECT *, CAST('0x' || right(h, 4) AS INT) % {shards} AS shard FROM line)",
        f"dealt AS MATERIALIZED (SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY h) - 1) // {batch} AS b FROM deal)",
        f"a0 AS MATERIALIZED (SELECT {', '.join(f'CAST(0 AS DOUBLE) AS w{k}_{j}' for k, j in cells)})",
    ]
    for e in range(1, epochs + 1):
        moved = ", ".join(f"any_value(w{k}_{j}) + 0.1 * coalesce(sum({xs[j]} * (CAST(y = {k} AS INT) - CAST(g = {k} AS INT))) FILTER (y <> g), 0)" for k, j in cells)
        scores = ", ".join(f"{x} AS s{k}" for k, x in enumerate(score))
        parts += [
            f"""s{e} AS (SELECT shard, CAST(0 AS BIGINT) AS b, CAST(0 AS HUGEINT) AS n, CAST(0 AS HUGEINT) AS wrong, {names} FROM (SELECT DISTINCT shard FROM dealt), a{e - 1}
            UNION ALL SELECT shard, b + 1, any_value(n) + count(*), any_value(wrong) + count(*) FILTER (y <> g), {moved}
            FROM (SELECT *, {guess} AS g FROM (SELECT s.*, y, {', '.join(FEATURES)}, {scores} FROM s{e} s JOIN dealt d ON d.shard = s.shard AND d.b = s.b)) GROUP BY shard, b)""",
            f"l{e} AS (SELECT * FROM s{e} QUALIFY row_number() OVER (PARTITION BY shard ORDER BY b DESC) = 1)",
            f"a{e} AS MATERIALIZED (SELECT {', '.join(f'sum(w{k}_{j} * n) / sum(n) AS w{k}_{j}' for k, j in cells)}, CAST(sum(wrong) AS BIGINT) AS errors FROM l{e})",
        ]
    last = f"guessed AS (SELECT y, {guess} AS g FROM (SELECT y, {', '.join(f'{x} AS s{k}' for k, x in enumerate(score))} FROM line, a{epochs}))"
    return f"WITH RECURSIVE {', '.join([*parts, last])} {result}"


_EPOCHS = 10
_ERRORS = " UNION ALL ".join(f"SELECT CAST({e} AS BIGINT) AS epoch, errors FROM a{e}" for e in range(1, _EPOCHS + 1))


@query("c1_perceptron", _sql_perceptron(_SQL_NOISY, 2, _EPOCHS, _ERRORS))
def c1(spark, d):
    """Errors per epoch of a perceptron learnt in shards."""
    rows = encode.standardised(noisy_lines(spark, d).select("id", "label", *FEATURES), FEATURES)
    fit = classify.perceptron(rows, "id", FEATURES, "label", classes=2, eta=0.1, num_iter=_EPOCHS, seed=1)
    return spark.createDataFrame([(i + 1, int(e)) for i, e in enumerate(fit.losses)], "epoch bigint, errors bigint")


_CONFUSION = """SELECT CAST(l.c AS BIGINT) AS label, CAST(p.c AS BIGINT) AS prediction, count(g) AS n
 FROM (SELECT y AS c FROM guessed UNION SELECT g FROM guessed) l CROSS JOIN (SELECT y AS c FROM guessed UNION SELECT g FROM guessed) p
 LEFT JOIN guessed ON y = l.c AND g = p.c GROUP BY 1, 2"""
_SQL_BANDS = f"(SELECT *, CASE WHEN price < 30000 THEN 0 WHEN price < 60000 THEN 1 ELSE 2 END AS label FROM {SQL_LINES})"


@query(
    "c4_multiclass_perceptron",
    _sql_perceptron(_SQL_BANDS, 3, _EPOCHS, _CONFUSION),
)
def c4(spark, d):
    """Three price bands by a perceptron with one weight row per class."""
    band = F.when(F.col("price") < 30000, 0).when(F.col("price") < 60000, 1).otherwise(2)
    rows = encode.standardised(lines(spark, d).withColumn("label", band).select("id", "label", *FEATURES), FEATURES)
    fit = classify.perceptron(rows, "id", FEATURES, "label", classes=3, eta=0.1, num_iter=_EPOCHS, seed=1)
    guessed = rows.withColumn("prediction", fit.predict(F.array(*FEATURES)))
    return metrics.confusion_counts(guessed.withColumn("label", big("label")), "label", "prediction")


def _logistic_fit(df):
    return LogisticRegression(regParam=0.0, standardization=True, maxIter=100, tol=1e-8).fit(df)


_BALANCE = """SELECT count(*) AS n, {mean} AS mean_p, {qty} AS qty_p, {price} AS price_p FROM {source}"""


@query(
    "c5_logistic_regression",
    _BALANCE.format(
        mean=sql_round("avg(label)", 5), qty=sql_round("avg(qty * label)", 4), price=sql_round("avg(price / 1000 * label)", 4), source=_SQL_NOISY
    ),
)
def c5(spark, d):
    """At the optimum the predicted probabilities balance like the labels do, feature by feature."""
    rows = columns.to_features(noisy_lines(spark, d), FEATURES)
    scored = _logistic_fit(rows).transform(rows).withColumn("p", columns.class_probability(1))
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        r(F.avg("p"), 5).alias("mean_p"),
        r(F.avg(F.col("qty") * F.col("p")), 4).alias("qty_p"),
        r(F.avg(F.col("price") / 1000 * F.col("p")), 4).alias("price_p"),
    )


@query(
    "p10_class_probability",
    f"SELECT count(*) AS n, {sql_round('CAST(sum(label) AS DOUBLE)', 1)} AS expected FROM {_SQL_NOISY}",
)
def p10(spark, d):
    """Sum of the class-1 probabilities: the expected number of positives."""
    rows = feature_rows(spark, d)
    scored = _logistic_fit(rows).transform(rows)
    return scored.agg(F.count(F.lit(1)).alias("n"), r(F.sum(columns.class_probability(1)), 1).alias("expected"))


_FLAGS = ["A", "N", "R"]


def flag_rows(spark, d):
    code = columns.recode(F.col("flag"), {f: F.lit(float(i)) for i, f in enumerate(_FLAGS)}, F.lit(None))
    return columns.to_features(evened(lines(spark, d)).withColumn("label", code), FEATURES)


def _one_vs_rest(spark, d):
    rows = flag_rows(spark, d)
    return rows, classify.one_vs_rest(LogisticRegression(regParam=0.0, maxIter=100, tol=1e-8)).fit(rows)


@query(
    "c6_one_vs_rest_members",
    f"SELECT {', '.join(sql_round(f'avg(CAST(flag = {chr(39)}{f}{chr(39)} AS INT))', 5) + f' AS p_{f}' for f in _FLAGS)} FROM {SQL_LINES}",
)
def c6_members(spark, d):
    """Each member's mean probability equals its class's share."""
    rows, model = _one_vs_rest(spark, d)
    aggs = []
    for k, flag in enumerate(_FLAGS):
        member = model.models[k].copy()
        rows = member.setProbabilityCol(f"q{k}").setRawPredictionCol(f"w{k}").setPredictionCol(f"y{k}").transform(rows)
        aggs.append(r(F.avg(vector_to_array(f"q{k}")[1]), 5).alias(f"p_{flag}"))
    return rows.agg(*aggs)


@query("c6_one_vs_rest")
def c6(spark, d):
    """Probabilities of all classes, scaled to sum 1, per true class."""
    rows, model = _one_vs_rest(spark, d)
    scored = classify.one_vs_rest_probabilities(model, rows.select("label", "features"))
    return scored.groupBy(big("label").alias("label")).agg(
        *[r(F.avg(F.col("probs")[k]), 5).alias(f"p{k}") for k in range(3)],
        r(F.max(F.abs(F.col("probs")[0] + F.col("probs")[1] + F.col("probs")[2] - 1)), 9).alias("worst_sum"),
    )


PENALTIES = [10.0**k for k in range(-5, 6)]


@query("c7_regularisation_path")
def c7(spark, d):
    """Weights for penalties 10^-5 .. 10^5 on standardised features, all in the same passes."""
    rows = encode.standardised(noisy_lines(spark, d).select("id", "label", *FEATURES), FEATURES)
    path = stacked.one_vs_rest_path(rows, "id", FEATURES, "label", [1.0], PENALTIES)
    return path.where("feature <> 'bias'").select("l2", "feature", r("weight", 4).alias("weight"))


def _flag_path(spark, d):
    code = columns.recode(F.col("flag"), {f: F.lit(float(i)) for i, f in enumerate(_FLAGS)}, F.lit(None))
    rows = cut_lineage(encode.standardised(lines(spark, d).withColumn("label", code).select("id", "label", *FEATURES), FEATURES))
    members = [stacked.Member(positive=float(c), l2=p) for p in PENALTIES for c in range(len(_FLAGS))]
    return rows, stacked.stacked_logistic(rows, "id", FEATURES, "label", members)


@query("c7_path_of_members")
def c7_members(spark, d):
    """Weights of every one-vs-rest member along the penalties."""
    _, fit = _flag_path(spark, d)
    rows = [(m.l2, int(m.positive), f, float(w)) for m, ws in zip(fit.members, fit.weights) for f, w in zip(["bias", *FEATURES], ws)]
    return spark.createDataFrame(rows, "l2 double, class bigint, feature string, weight double").withColumn("weight", r("weight", 4))


_SCALED = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}" for c in FEATURES)
_SHARES = " UNION ALL ".join(
    f"SELECT CAST({k} AS BIGINT) AS class, '{f}' AS feature, avg({'1' if f == 'bias' else f} * CAST(flag = '{flag}' AS INT)) AS balance FROM x" for k, flag in enumerate(_FLAGS) for f in ["bias", *FEATURES]
)


@query(
    "c7_path_optimum",
    f"""WITH x AS MATERIALIZED (SELECT flag, {_SCALED} FROM {SQL_LINES}), s AS ({_SHARES})
    SELECT l2, class, feature, {sql_round('balance', 5)} AS balance FROM s, (SELECT unnest([{', '.join(f'CAST({p!r} AS DOUBLE)' for p in PENALTIES)}]) AS l2)""",
)
def c7_optimum(spark, d):
    """Every member of the path is at its optimum: predictions and penalty balance what the labels give."""
    rows, fit = _flag_path(spark, d)
    found = stacked.balances(rows, FEATURES, fit)
    return found.select("l2", big("class").alias("class"), "feature", r("balance", 5).alias("balance"))


@query(
    "c11_multiclass_svm",
    f"""SELECT CAST(CASE WHEN p_size <= 15 THEN 0 WHEN p_size <= 35 THEN 1 ELSE 2 END AS DOUBLE) AS prediction, count(*) AS n FROM part
    WHERE p_size NOT BETWEEN 11 AND 19 AND p_size NOT BETWEEN 31 AND 39 GROUP BY 1""",
)
def c11_multiclass(spark, d):
    """Three separated size classes through one-against-the-rest support vectors come back as they are."""
    size = F.col("p_size")
    parts = table(spark, d, "part").where(~size.between(11, 19) & ~size.between(31, 39))
    band = F.when(size <= 15, 0.0).when(size <= 35, 1.0).otherwise(2.0)
    place = lambda at: F.exp(-((size - at) * (size - at)) / F.lit(200.0))
    rows = columns.to_features(parts.select(band.alias("label"), place(5).alias("a"), place(25).alias("b"), place(45).alias("c")), ["a", "b", "c"])
    model = classify.margin_one_vs_rest(rows, classify.SupportVectorClassifier(kernel="linear", C=10.0, maxIter=30))
    return model.transform(rows.select("features")).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


@query("c11_linear_svm")
def c11(spark, d):
    train, test = split_rows(spark, d)
    model = Pipeline(stages=[scaler(), classify.SupportVectorClassifier(featuresCol="scaled", kernel="linear", C=1.0)]).fit(train)
    return test_scores(model, test)


@query("c11_rbf_svm")
def c11_rbf(spark, d):
    train, test = split_rows(spark, d)
    model = Pipeline(stages=[scaler(), classify.SupportVectorClassifier(featuresCol="scaled", kernel="rbf", C=1.0)]).fit(train)
    return test_scores(model, test)


_WAVES, _PHASES = classify.fourier_waves(2, 4, gamma=0.5, seed=1)


def _sql_wave(k: int) -> str:
    return sql_round(f"sqrt(2.0 / 4) * cos({float(_PHASES[k])!r} + x1 * ({float(_WAVES[k, 0])!r}) + x2 * ({float(_WAVES[k, 1])!r}))", 8)


@query(
    "c11_fourier_features",
    f"SELECT id, {', '.join(f'{_sql_wave(k)} AS z{k}' for k in range(4))} FROM (SELECT id, qty / 10 AS x1, disc * 10 AS x2 FROM {SQL_LINES})",
)
def c11_features(spark, d):
    """The kernel's random cosine features of every line."""
    x1, x2 = F.col("qty") / 10, F.col("disc") * 10
    waves = classify.fourier_columns([x1, x2], _WAVES, _PHASES)
    return lines(spark, d).select("id", *[r(z, 8).alias(f"z{k}") for k, z in enumerate(waves)])


# ---- trees and ensembles -------------------------------------------------------------------


@query("c8_decision_tree")
def c8(spark, d):
    train, test = split_rows(spark, d)
    return test_scores(ensemble.decision_tree(max_depth=4).fit(train), test)


_STUMP = "(SELECT CAST(p_size > 20 OR p_retailprice < 910 AS INT) AS label, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part)"


@query(
    "c8_stump",
    f"""WITH t AS {_STUMP}, v AS (SELECT 'p_size' AS feature, size AS x, label FROM t UNION ALL SELECT 'p_retailprice', price, label FROM t),
    g AS (SELECT feature, x, count_if(label = 0) AS c0, count_if(label = 1) AS c1 FROM v GROUP BY 1, 2),
    s AS (SELECT feature, x, sum(c0) OVER w AS l0, sum(c1) OVER w AS l1, sum(c0) OVER f AS t0, sum(c1) OVER f AS t1 FROM g
      WINDOW w AS (PARTITION BY feature ORDER BY x), f AS (PARTITION BY feature)),
    i AS (SELECT feature, x AS threshold, l0 + l1 AS nl, t0 - l0 + t1 - l1 AS nr, l0, l1, t0 - l0 AS r0, t1 - l1 AS r1 FROM s)
    SELECT feature, threshold, {sql_round('(nl * (1 - pow(l0 / nl, 2) - pow(l1 / nl, 2)) + nr * (1 - pow(r0 / nr, 2) - pow(r1 / nr, 2))) / (nl + nr)', 9)} AS gini
    FROM i WHERE nr > 0""",
)
def c8_stump(spark, d):
    """Impurity of every split of a tree of depth one."""
    rows = table(spark, d, "part").withColumn("label", ((F.col("p_size") > 20) | (F.col("p_retailprice") < 910)).cast("int"))
    scores = classify.split_scores(rows, ["p_size", "p_retailprice"], "label", [0, 1])
    return scores.select("feature", "threshold", r("gini", 9).alias("gini"))


def _sql_tree(source: str, cost: str, leaf: str) -> str:
    """Leaves of the best split ``size <= t`` by ``cost`` over both sides (n, s, q = rows, sum, sum of squares)."""
    return f"""WITH t AS {source}, g AS (SELECT size, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM t GROUP BY 1),
    c AS (SELECT size, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(q) OVER w AS lq, sum(n) OVER () AS n, sum(s) OVER () AS s, sum(q) OVER () AS q FROM g WINDOW w AS (ORDER BY size)),
    b AS (SELECT size FROM c WHERE ln < n ORDER BY {cost.format(n='ln', s='ls', q='lq')} + {cost.format(n='(n - ln)', s='(s - ls)', q='(q - lq)')}, size LIMIT 1)
    SELECT {leaf} AS value, count(*) AS n FROM t GROUP BY t.size <= (SELECT size FROM b)"""


_TREE_ROWS = f"""(SELECT CAST(p_size AS DOUBLE) AS size, CAST((p_size > 20) <> ({sql_uniform(9, 'p_partkey')} < 0.1) AS DOUBLE) AS y FROM part)"""


def _tree_rows(spark, d):
    label = ((F.col("p_size") > 20) != uniform_below(9, 0.1, "p_partkey")).cast("double")
    return columns.to_features(table(spark, d, "part").withColumn("label", label), ["p_size"])


@query("c8_tree_leaves", _sql_tree(_TREE_ROWS, "({s} - {s} * {s} / {n})", sql_round("avg(y)")))
def c8_leaves(spark, d):
    """Share of positives and rows in both leaves of a fitted tree of depth one."""
    rows = _tree_rows(spark, d)
    scored = ensemble.decision_tree(max_depth=1, maxBins=64).fit(rows).transform(rows)
    leaves = scored.withColumn("value", columns.class_probability(1)).groupBy("value")
    return leaves.agg(F.count(F.lit(1)).alias("n")).select(r("value").alias("value"), "n")


@query(
    "r8_tree_leaves",
    _sql_tree("(SELECT CAST(p_size AS DOUBLE) AS size, abs(p_size - 17) * 1.0 + p_retailprice / 100 AS y FROM part)", "({q} - {s} * {s} / {n})", sql_round("avg(y)")),
)
def r8_leaves(spark, d):
    """Mean and rows in both leaves of a fitted regression tree of depth one."""
    label = F.abs(F.col("p_size") - 17) * 1.0 + F.col("p_retailprice") / 100
    rows = columns.to_features(table(spark, d, "part").withColumn("label", label), ["p_size"])
    scored = ensemble.regression_tree(max_depth=1, maxBins=64).fit(rows).transform(rows)
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).select(r("prediction").alias("value"), "n")


@query("c9_forest_importances")
def c9(spark, d):
    train, _ = split_rows(spark, d)
    model = ensemble.random_forest(n_estimators=20, max_depth=6).fit(train)
    return ensemble.importances(model, FEATURES).select("feature", r("importance", 5).alias("importance"))


_PARTS = f"""(SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, CAST(p_size * 7 % 3 AS BIGINT) AS label,
 row_number() OVER (ORDER BY {sql_hash(5, 'p_partkey')}) <= floor(0.3 * count(*) OVER ()) AS is_test FROM part)"""


def part_points(spark, d):
    parts = table(spark, d, "part").select(
        "p_partkey",
        F.array(F.col("p_size").cast("double"), "p_retailprice").alias("vec"),
        big(F.col("p_size") * 7 % 3).alias("label"),
    )
    split = cut_lineage(sampling.random_split(parts, "p_partkey", 0.3, seed=5))
    return split.where(~F.col("is_test")), split.where("is_test")


@query(
    "c10_nearest_neighbour_classifier",
    f"""WITH p AS MATERIALIZED {_PARTS}, d AS (SELECT q.p_partkey AS query, t.label, row_number() OVER (PARTITION BY q.p_partkey
      ORDER BY (q.x - t.x) * (q.x - t.x) + (q.y - t.y) * (q.y - t.y), t.p_partkey) AS rank FROM p q JOIN p t ON q.is_test AND NOT t.is_test),
    s AS (SELECT query, count_if(label = 0) / 5 AS p_0, count_if(label = 1) / 5 AS p_1, count_if(label = 2) / 5 AS p_2 FROM d WHERE rank <= 5 GROUP BY 1)
    SELECT query, {sql_round('p_0')} AS p_0, {sql_round('p_1')} AS p_1, {sql_round('p_2')} AS p_2,
    CAST(CASE WHEN p_0 >= p_1 AND p_0 >= p_2 THEN 0 WHEN p_1 >= p_2 THEN 1 ELSE 2 END AS BIGINT) AS prediction FROM s""",
)
def c10(spark, d):
    """Class shares among the five nearest training parts."""
    train, test = part_points(spark, d)
    near = neighbors.nearest(train, test, "p_partkey", "vec", "label", k=5)
    shares = neighbors.neighbour_shares(near, [0, 1, 2])
    return shares.select("query", r("p_0").alias("p_0"), r("p_1").alias("p_1"), r("p_2").alias("p_2"), big("prediction").alias("prediction"))


_VECTORS = f"(SELECT vec_id, embedding::DOUBLE[] AS v, CAST(label AS BIGINT) AS label, row_number() OVER (ORDER BY {sql_hash(6, 'vec_id')}) <= floor(0.2 * count(*) OVER ()) AS is_test FROM embeddings)"


def vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vec"), big("label").alias("label"))


@query(
    "j3_nearest_rows",
    f"""WITH e AS MATERIALIZED {_VECTORS}, d AS (SELECT q.vec_id AS query, t.vec_id AS neighbour, list_distance(q.v, t.v) AS distance,
      row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, t.v), t.vec_id) AS rank FROM e q JOIN e t ON q.is_test AND NOT t.is_test)
    SELECT query, neighbour, {sql_round('distance')} AS distance, rank FROM d WHERE rank <= 5""",
)
def j3(spark, d):
    split = cut_lineage(sampling.random_split(vectors(spark, d), "vec_id", 0.2, seed=6))
    near = neighbors.nearest(split.where(~F.col("is_test")), split.where("is_test"), "vec_id", "vec", "label", k=5)
    return near.select("query", "neighbour", r(F.sqrt("d2")).alias("distance"), big("rank").alias("rank"))


@query(
    "j4_distances_to_others",
    f"""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
    SELECT a.vec_id, {sql_round('min(list_distance(a.v, b.v))')} AS nearest, {sql_round('avg(list_distance(a.v, b.v))')} AS mean,
    {sql_round('max(list_distance(a.v, b.v))')} AS farthest FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY 1""",
)
def j4(spark, d):
    """Nearest, mean and farthest distance from each vector to all others."""
    out = neighbors.distance_summary(vectors(spark, d), "vec_id", "vec")
    return out.select("vec_id", r("nearest").alias("nearest"), r("mean").alias("mean"), r("farthest").alias("farthest"))


_VOTE_ROWS = f"""(SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS x, CAST((p_size > 20) <> ({sql_uniform(9, 'p_partkey')} < 0.1) AS DOUBLE) AS y, p_partkey % 3 = 0 AS is_test FROM part)"""


@query(
    "c12_vote_of_two",
    f"""WITH t AS MATERIALIZED {_VOTE_ROWS}, g AS (SELECT x AS size, count(*) AS n, sum(y) AS s FROM t WHERE NOT is_test GROUP BY 1),
    c AS (SELECT size, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER () AS n, sum(s) OVER () AS s FROM g WINDOW w AS (ORDER BY size)),
    b AS (SELECT size FROM c WHERE ln < n ORDER BY ls - ls * ls / ln + (s - ls) - (s - ls) * (s - ls) / (n - ln), size LIMIT 1),
    leaf AS (SELECT x <= (SELECT size FROM b) AS side, avg(y) AS p FROM t WHERE NOT is_test GROUP BY 1),
    near AS (SELECT q.id, t.y, row_number() OVER (PARTITION BY q.id ORDER BY abs(q.x - t.x), CAST(t.id AS VARCHAR)) AS rn FROM t q JOIN t ON q.is_test AND NOT t.is_test)
    SELECT q.id, {sql_round('0.25 * leaf.p + 0.75 * avg(near.y)')} AS p1 FROM t q JOIN leaf ON leaf.side = (q.x <= (SELECT size FROM b)) JOIN near ON near.id = q.id AND near.rn <= 5
    GROUP BY q.id, leaf.p""",
)
def c12_pair(spark, d):
    """A stump (weight 1) and five nearest neighbours (weight 3) vote on every third part."""
    label = ((F.col("p_size") > 20) != uniform_below(9, 0.1, "p_partkey")).cast("double")
    parts = columns.to_features(table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x"), label.alias("label")), ["x"])
    members = [("tree", ensemble.decision_tree(max_depth=1, maxBins=64)), ("neighbours", estimators.NearestNeighbours(k=5))]
    model = estimators.SoftVote(members, [1.0, 3.0]).fit(parts.where("id % 3 <> 0"))
    return model.transform(parts.where("id % 3 = 0")).select("id", r(columns.class_probability(1)).alias("p1"))


@query("c12_soft_vote")
def c12(spark, d):
    """A scaled logistic regression, a stump and nearest neighbours vote with their probabilities."""
    parts = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x0"), F.col("p_retailprice").alias("x1"),
        ((F.col("p_size") > 20) != uniform_below(9, 0.1, "p_partkey")).cast("double").alias("label"),
    )
    rows = cut_lineage(columns.to_features(sampling.stratified_split(parts, "id", "label", 0.5, seed=1), ["x0", "x1"]))
    voted = vote_members()["vote"].fit(rows.where(~F.col("is_test"))).transform(rows.where("is_test"))
    auc = metrics.roc_auc(voted.withColumn("s", columns.class_probability(1)), "label", "s").scalar()
    return voted.agg(F.count(F.lit(1)).alias("n"), r(metrics.accuracy("label", "prediction")).alias("accuracy"), r(auc).alias("auc"))


@query("c13_bagged_trees")
def c13(spark, d):
    train, test = split_rows(spark, d)
    return test_scores(ensemble.bagged_trees(n_estimators=20, max_depth=6).fit(train), test)


@query("c13_bagged_logistic")
def c13_any(spark, d):
    """A thousand logistic regressions, each on its own bootstrap, fitted in the same passes."""
    train, test = (encode.standardised(x, FEATURES) for x in _plain_split(spark, d))
    fit = stacked.stacked_logistic(train, "id", FEATURES, "label", [stacked.Member(draw=i) for i in range(1000)], tol=1e-6)
    voted = fit.probabilities(test.select("id", "label", *FEATURES), FEATURES).withColumn("prediction", (F.col("p") > 0.5).cast("double"))
    return voted.agg(F.count(F.lit(1)).alias("n"), r(metrics.accuracy("label", "prediction")).alias("accuracy"))


ROUNDS, RATE = 500, 0.1
_EDGES = {"qty": [5.0 * k for k in range(1, 10)], "price": [5000.0 * k for k in range(1, 19)], "disc": [0.015 + 0.02 * k for k in range(5)], "tax": [0.015 + 0.02 * k for k in range(4)]}


def _sql_round(source: str, weight: str) -> str:
    """The split of lowest Gini index of a weighted table: rows are summed per bin, then both sides of every edge."""
    bins = " UNION ALL ".join(
        f"SELECT {i} AS f, {' + '.join(f'CAST({c} > {e} AS INT)' for e in edges)} AS bin, coalesce(sum({weight}) FILTER (label = 0), 0) AS a, coalesce(sum({weight}) FILTER (label = 1), 0) AS b FROM {source} GROUP BY 2"
        for i, (c, edges) in enumerate(_EDGES.items())
    )
    cuts = ", ".join(f"({i}, '{c}', {k + 1}, CAST({e} AS DOUBLE))" for i, (c, edges) in enumerate(_EDGES.items()) for k, e in enumerate(edges))
    return f"""(SELECT f, feature, edge, sum(least(a, b)) AS error, bool_or(low AND b > a) AS low_is_one, bool_or(NOT low AND b > a) AS high_is_one, sum(a + b - (a * a + b * b) / (a + b)) AS cost
      FROM (SELECT c.f, feature, edge, bin < k AS low, sum(a) AS a, sum(b) AS b FROM (VALUES {cuts}) AS c(f, feature, k, edge) JOIN ({bins}) AS h ON c.f = h.f GROUP BY 1, 2, 3, 4)
      GROUP BY 1, 2, 3 HAVING count(*) = 2 ORDER BY round(cost, 12), f, edge LIMIT 1)"""


def _sql_stump(row: str) -> str:
    cases = " ".join(f"WHEN '{c}' THEN t.{c} <= {row}.edge" for c in _EDGES)
    return f"CASE WHEN CASE {row}.feature {cases} END THEN {row}.low_is_one ELSE {row}.high_is_one END"


@query("c14_adaboost")
def c14(spark, d):
    """Weighted error and weight of each of 500 boosting rounds at a rate of 0.1."""
    train, _ = _plain_split(spark, d)
    model = boosting.adaboost_binned(train, _EDGES, "label", ROUNDS, RATE)
    rows = [(i + 1, float(e), float(a)) for i, (e, a) in enumerate(zip(model.errors, model.alphas))]
    return spark.createDataFrame(rows, "round bigint, error double, alpha double")


@query(
    "c14_first_rounds",
    f"""WITH t AS MATERIALIZED (SELECT *, 1.0::DOUBLE / count(*) OVER () AS w FROM {_SQL_NOISY}), one AS MATERIALIZED {_sql_round('t', 'w')},
    a AS (SELECT *, {RATE} * 0.5 * ln((1 - error) / error) AS alpha FROM one),
    u AS MATERIALIZED (SELECT t.qty, t.price, t.disc, t.tax, t.label, t.w * exp(CASE WHEN ({_sql_stump('a')}) <> (label = 1) THEN alpha ELSE -alpha END) AS raw FROM t, a),
    v AS MATERIALIZED (SELECT *, raw / sum(raw) OVER () AS w2 FROM u), two AS {_sql_round('v', 'w2')}
    SELECT CAST(round AS BIGINT) AS round, feature, {sql_round('error', 8)} AS error, {sql_round(f'{RATE} * 0.5 * ln((1 - error) / error)', 8)} AS alpha
    FROM (SELECT 1 AS round, feature, error FROM one UNION ALL SELECT 2, feature, error FROM two)""",
)
def c14_first(spark, d):
    """Split feature, error and weight of the first two rounds over all lines."""
    model = boosting.adaboost_binned(noisy_lines(spark, d), _EDGES, "label", 2, RATE)
    rows = [(i + 1, list(_EDGES)[t.feature], e, a) for i, (t, e, a) in enumerate(zip(model.trees, model.errors, model.alphas))]
    found = spark.createDataFrame(rows, "round bigint, feature string, error double, alpha double")
    return found.select("round", "feature", r("error", 8).alias("error"), r("alpha", 8).alias("alpha"))


@query("c14_adaboost_scores")
def c14_scores(spark, d):
    """Accuracy and ROC area on test rows after 500 rounds of trees of depth two."""
    train, test = _plain_split(spark, d)
    scored = boosting.adaboost_binned(train, _EDGES, "label", ROUNDS, RATE, max_depth=2).transform(test)
    auc = metrics.roc_auc(scored, "label", "score").scalar()
    return scored.agg(F.count(F.lit(1)).alias("n"), r(metrics.accuracy("label", "prediction")).alias("accuracy"), r(auc).alias("auc"))


@query(
    "c15_boosting_step",
    f"""WITH t AS (SELECT id, label, CAST(price > 45000 AS BIGINT) AS prediction, 1.0 / count(*) OVER () AS w FROM {_SQL_NOISY}),
    e AS (SELECT sum(CASE WHEN label <> prediction THEN w ELSE 0 END) AS e FROM t),
    s AS (SELECT id, e, 0.5 * ln((1 - e) / e) AS a, w * exp(CASE WHEN label <> prediction THEN 0.5 * ln((1 - e) / e) ELSE -0.5 * ln((1 - e) / e) END) AS raw FROM t, e)
    SELECT id, {sql_round('e', 9)} AS error, {sql_round('a', 9)} AS alpha, {sql_round('raw / sum(raw) OVER () * 1000', 9)} AS new_weight FROM s""",
)
def c15(spark, d):
    """One round of re-weighting all lines (weights in thousandths)."""
    rows = noisy_lines(spark, d).select("id", "label", (F.col("price") > 45000).cast("double").alias("prediction"))
    n = rows.agg(F.count(F.lit(1))).scalar()
    out = ensemble.boosting_step(rows.withColumn("w", F.lit(1.0) / n), "label", "prediction", "w")
    return out.select("id", r("error", 9).alias("error"), r("alpha", 9).alias("alpha"), r(F.col("new_weight") * 1000, 9).alias("new_weight"))


@query("c16_gradient_boosting")
def c16(spark, d):
    train, test = split_rows(spark, d)
    return test_scores(ensemble.boosted_trees(n_estimators=10, learning_rate=0.1, max_depth=4).fit(train), test)


def _regression_split(spark, d):
    rows = lines(spark, d).select("id", (F.col("price") * (1 - F.col("disc")) / 1000).alias("label"), "qty", "price", "disc", "tax")
    kept = cut_lineage(columns.to_features(sampling.random_split(rows, "id", 0.3, seed=123), FEATURES).select("label", "features", "is_test"))
    return kept.where(~F.col("is_test")), kept


def _by_split(model, rows):
    scores = metrics.regression_scores(model.transform(rows), "label", "prediction", by=["is_test"])
    return scores.select("is_test", "n", r("mse", 3).alias("mse"), r("mae", 3).alias("mae"), r("r2", 5).alias("r2"))


@query("r8_regression_tree")
def r8(spark, d):
    train, rows = _regression_split(spark, d)
    return _by_split(ensemble.regression_tree(max_depth=3).fit(train), rows)


@query("r9_regression_forest")
def r9(spark, d):
    train, rows = _regression_split(spark, d)
    return _by_split(ensemble.regression_forest(n_estimators=20, max_depth=6).fit(train), rows)


# ---- clusters ----------------------------------------------------------------------------------

_POINTS = f"(SELECT id, qty / 10 AS x1, price / 20000 AS x2 FROM {SQL_LINES})"
_START = f"(SELECT row_number() OVER (ORDER BY {sql_hash(0, 'id')}) - 1 AS c, x1, x2 FROM {_POINTS} QUALIFY c < 3)"


def points(spark, d):
    return lines(spark, d).select("id", (F.col("qty") / 10).alias("x1"), (F.col("price") / 20000).alias("x2"))


def starts(rows) -> np.ndarray:
    """The three rows of smallest hash."""
    return np.array([[p["x1"], p["x2"]] for p in rows.orderBy(seeded_hash(0, "id")).limit(3).collect()])


def _sql_assign(centres: str) -> str:
    return f"""(SELECT id, x1, x2, c AS cluster, d2 FROM (SELECT p.id, p.x1, p.x2, k.c, (p.x1 - k.x1) * (p.x1 - k.x1) + (p.x2 - k.x2) * (p.x2 - k.x2) AS d2,
     row_number() OVER (PARTITION BY p.id ORDER BY (p.x1 - k.x1) * (p.x1 - k.x1) + (p.x2 - k.x2) * (p.x2 - k.x2), k.c) AS rn FROM {_POINTS} p, {centres} k) WHERE rn = 1)"""


def _sql_lloyd(steps: int) -> str:
    parts = [f"k0 AS MATERIALIZED {_START}"]
    for s in range(1, steps + 1):
        parts.append(f"k{s} AS MATERIALIZED (SELECT cluster AS c, avg(x1) AS x1, avg(x2) AS x2 FROM {_sql_assign(f'k{s - 1}')} GROUP BY 1)")
    return "WITH " + ", ".join(parts)


@query("k1_lloyd_steps", _sql_lloyd(5) + f" SELECT c AS cluster, {sql_round('x1')} AS x1, {sql_round('x2')} AS x2 FROM k5")
def k1_lloyd(spark, d):
    """Centres after five rounds from fixed starts."""
    rows = points(spark, d)
    centres = cluster.lloyd_steps(rows, ["x1", "x2"], starts(rows), 5)
    frame = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(centres)], "cluster bigint, x1 double, x2 double")
    return frame.select("cluster", r("x1").alias("x1"), r("x2").alias("x2"))


@query("k3_labels_and_inertia", f"SELECT cluster, count(*) AS n, {sql_round('sum(d2)', 4)} AS inertia FROM {_sql_assign(_START)} GROUP BY 1")
def k3(spark, d):
    rows = points(spark, d)
    placed = cluster.with_nearest(rows, ["x1", "x2"], starts(rows))
    return placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), r(F.sum("d2"), 4).alias("inertia"))


def _sizes(model, rows):
    return model.transform(rows).groupBy(big("cluster").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))


def point_vectors(spark, d):
    return columns.to_features(points(spark, d), ["x1", "x2"]).select("id", "features")


def _cluster_rows(spark, fit, names=("x1", "x2")):
    rows = [(i, int(n), *(float(v) for v in c)) for i, (n, c) in enumerate(zip(fit.sizes, fit.centres))]
    return spark.createDataFrame(rows, "cluster bigint, n bigint, " + ", ".join(f"{n} double" for n in names))


def point_arrays(spark, d):
    return evened(points(spark, d).select("id", F.array("x1", "x2").alias("vec")))


@query("k1_kmeans_random")
def k1(spark, d):
    """Best of ten random starts, all moved in the same passes."""
    fit = cluster.kmeans(point_arrays(spark, d), "id", "vec", 3, init="random", n_init=10, max_iter=300, tol=1e-4)
    return _cluster_rows(spark, fit)


@query("k2_kmeans_plus_plus")
def k2(spark, d):
    """Best of ten spread-out starts."""
    fit = cluster.kmeans(point_arrays(spark, d), "id", "vec", 3, init="k-means++", n_init=10, max_iter=300, tol=1e-4)
    return _cluster_rows(spark, fit)


@query("k2_kmeans_parallel")
def k2_parallel(spark, d):
    """Spark ML's own fit with its parallel start."""
    rows = columns.to_features(points(spark, d), ["x1", "x2"]).select("id", "features")
    model = cluster.ml_kmeans(rows, 3, max_iter=50)
    return model.transform(rows).groupBy(big("cluster").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))


@query("k4_elbow")
def k4(spark, d):
    """Inertia for one to ten clusters, best of ten starts each."""
    return cluster.elbow(point_arrays(spark, d), "id", "vec", range(1, 11), n_init=10, max_iter=300)


@query("k4_single_cluster", f"SELECT CAST(1 AS BIGINT) AS k, {sql_round('(var_pop(x1) + var_pop(x2)) * count(*)', 4)} AS inertia FROM {_POINTS}")
def k4_single(spark, d):
    return cluster.elbow(point_arrays(spark, d), "id", "vec", [1], n_init=1).select("k", r("inertia", 4).alias("inertia"))


def _sql_silhouette(distance: str) -> str:
    return f"""(WITH e AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS v, CAST(label AS BIGINT) AS cluster FROM embeddings),
    m AS (SELECT a.vec_id, a.cluster, b.cluster AS other, sum({distance}) / count(*) AS mean FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
    s AS (SELECT vec_id, cluster, max(mean) FILTER (WHERE other = cluster) AS a, min(mean) FILTER (WHERE other <> cluster) AS b FROM m GROUP BY 1, 2)
    SELECT vec_id, cluster, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM s)"""


_EUCLID = _sql_silhouette("list_distance(a.v, b.v)")


@query("k5_silhouette", f"SELECT vec_id, cluster, {sql_round('silhouette')} AS silhouette FROM {_EUCLID}")
def k5(spark, d):
    """Silhouette of each embedding under its label, Euclidean."""
    rows = vectors(spark, d).withColumnRenamed("label", "cluster")
    return cluster.silhouette(rows, "vec_id", "vec", "cluster").select("vec_id", "cluster", r("silhouette").alias("silhouette"))


@query("k5_silhouette_squared", f"SELECT vec_id, cluster, {sql_round('silhouette')} AS silhouette FROM {_sql_silhouette('pow(list_distance(a.v, b.v), 2)')}")
def k5_squared(spark, d):
    """As above with squared distances, linear in the rows."""
    rows = vectors(spark, d).withColumnRenamed("label", "cluster")
    return cluster.silhouette_squared(rows, "vec_id", "vec", "cluster", 64).select("vec_id", "cluster", r("silhouette").alias("silhouette"))


@query(
    "k6_silhouette_summary",
    f"""SELECT cluster, {sql_round('avg(silhouette)')} AS mean, {sql_round('min(silhouette)')} AS low, {sql_round('max(silhouette)')} AS high, count(*) AS n FROM {_EUCLID} GROUP BY 1""",
)
def k6(spark, d):
    rows = vectors(spark, d).withColumnRenamed("label", "cluster")
    values = cluster.silhouette(rows, "vec_id", "vec", "cluster")
    return values.groupBy("cluster").agg(
        r(F.avg("silhouette")).alias("mean"), r(F.min("silhouette")).alias("low"), r(F.max("silhouette")).alias("high"), F.count(F.lit(1)).alias("n")
    )


@query(
    "k6_silhouette_order",
    f"""SELECT vec_id, cluster, row_number() OVER (PARTITION BY cluster ORDER BY s, vec_id) AS pos FROM (SELECT vec_id, cluster, {sql_round('silhouette')} AS s FROM {_EUCLID})""",
)
def k6_order(spark, d):
    """Vectors of each cluster in order of their silhouette."""
    rows = vectors(spark, d).withColumnRenamed("label", "cluster")
    values = cluster.silhouette(rows, "vec_id", "vec", "cluster").withColumn("s", r("silhouette")).drop("silhouette")
    return stats.sorted_within(values, "cluster", ["s", "vec_id"]).select("vec_id", "cluster", "pos")


@query(
    "k7_bisecting",
    """SELECT cluster, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY x) - 1 AS cluster, x FROM (SELECT DISTINCT o_custkey % 3 AS x FROM orders)) c
    JOIN (SELECT o_custkey % 3 AS x FROM orders) o USING (x) GROUP BY 1""",
)
def k7_bisecting(spark, d):
    """Three far groups of orders, cut from the top down; groups are numbered by their place."""
    placed = (F.col("o_custkey") % 3 * 100 + F.col("o_orderkey") % 7).cast("double")
    rows = columns.to_features(table(spark, d, "orders").select(placed.alias("x")), ["x"])
    found = cluster.bisect(rows, 3).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x"))
    return ordered_rank(found, ["x"], "rn").select((F.col("rn") - 1).alias("cluster"), "n")


@query("k7_agglomerative")
def k7(spark, d):
    """Three clusters from merging twenty micro-clusters."""
    rows = columns.to_features(points(spark, d), ["x1", "x2"]).select("id", "features")
    placed, _ = cluster.agglomerate(rows, 3, micro=20)
    return placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


_NATIONS = "(SELECT s_nationkey AS k, avg(l_quantity) / 10 AS a, avg(l_discount) * 100 AS b, avg(l_tax) * 100 AS c FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1)"


def _nation_items(spark, d):
    """The nations' mean line."""
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    per_supplier = table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"), F.sum("l_discount").alias("d"), F.sum("l_tax").alias("t")
    )
    n = F.sum("n")
    mean = F.array(F.sum("q") / n / 10, F.sum("d") / n * 100, F.sum("t") / n * 100)
    return per_supplier.join(suppliers, "l_suppkey").groupBy(big("s_nationkey").alias("nation")).agg(mean.alias("vec"))


_SQL_MERGES = f"""WITH RECURSIVE n AS MATERIALIZED (SELECT row_number() OVER (ORDER BY k) - 1 AS k, CAST(k AS BIGINT) AS nation, a, b, c FROM {_NATIONS}),
    p AS (SELECT 0 AS step, x.k AS a, y.k AS b, sqrt(pow(x.a - y.a, 2) + pow(x.b - y.b, 2) + pow(x.c - y.c, 2)) AS d FROM n x JOIN n y ON x.k < y.k
      UNION ALL SELECT step + 1, least(x, y), greatest(x, y), max(d) FROM (
        SELECT step, d, CASE WHEN p.a = m.b THEN m.a ELSE p.a END AS x, CASE WHEN p.b = m.b THEN m.a ELSE p.b END AS y
        FROM p, (SELECT a, b FROM p ORDER BY d, a, b LIMIT 1) m) WHERE x <> y GROUP BY step, least(x, y), greatest(x, y)),
    m AS MATERIALIZED (SELECT step, a, b, d FROM p QUALIFY row_number() OVER (PARTITION BY step ORDER BY d, a, b) = 1)"""


@query(
    "k7_merge_tree",
    f"""{_SQL_MERGES} SELECT CAST(m.step AS BIGINT) AS step, {sql_round('m.d')} AS distance,
    coalesce((SELECT max(o.step) FROM m o WHERE o.step < m.step AND o.a = m.a) + (SELECT count(*) FROM n), m.a) AS "left",
    coalesce((SELECT max(o.step) FROM m o WHERE o.step < m.step AND o.a = m.b) + (SELECT count(*) FROM n), m.b) AS "right" FROM m""",
)
def k7_tree(spark, d):
    """Complete-linkage merges of the nations' mean lines, in rounds to the end."""
    tree = linkage.merge_tree(_nation_items(spark, d), "nation", "vec", finish=0)
    return tree.select("step", r("distance").alias("distance"), "left", "right")


@query(
    "k7_first_merge",
    f"""WITH n AS {_NATIONS} SELECT {sql_round('min(sqrt(pow(x.a - y.a, 2) + pow(x.b - y.b, 2) + pow(x.c - y.c, 2)))')} AS distance FROM n x JOIN n y ON x.k < y.k""",
)
def k7_first(spark, d):
    tree = linkage.merge_tree(_nation_items(spark, d), "nation", "vec")
    return tree.where("step = 0").select(r("distance").alias("distance"))


@query(
    "k7_merge_labels",
    f"""{_SQL_MERGES}, k AS (SELECT a, b FROM m WHERE step < (SELECT count(*) FROM n) - 5),
    w AS (SELECT k AS item, k AS place FROM n UNION ALL SELECT w.item, k.a FROM w JOIN k ON k.b = w.place),
    g AS (SELECT item, min(place) AS root FROM w GROUP BY 1) SELECT n.nation, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM g JOIN n ON n.k = g.item""",
)
def k7_labels(spark, d):
    """The nations in five clusters of the tree."""
    items = cut_lineage(_nation_items(spark, d))
    merges = linkage.complete_linkage(linkage.pair_distances(items, "nation", "vec"))
    return linkage.cut(merges, items, "nation", 5)


@query("k7_supplier_tree")
def k7_suppliers(spark, d):
    """Complete-linkage merges of all suppliers' mean lines: the merges and the largest distance of every tenth of the tree."""
    mean = F.array(F.avg("l_quantity") / 10, F.avg("l_discount") * 100, F.avg("l_tax") * 100, F.avg("l_extendedprice") / 10000)
    items = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("supplier")).agg(mean.alias("vec"))
    tree = cut_lineage(linkage.merge_tree(items, "supplier", "vec"))
    n = tree.agg(F.count(F.lit(1))).scalar()
    tenth = F.floor(F.col("step") * 10 / n)
    return tree.groupBy(tenth.alias("tenth")).agg(F.count(F.lit(1)).alias("merges"), r(F.max("distance")).alias("distance"))


# ---- components and topics ------------------------------------------------------------------------

_PAIR = f"(SELECT id, qty / 10 AS x1, disc * 10 AS x2 FROM {SQL_LINES})"
_EIGEN = f"""(WITH m AS (SELECT var_samp(x1) a, var_samp(x2) c, covar_samp(x1, x2) b FROM {_PAIR}),
 l AS (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS l0, (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS l1 FROM m),
 v AS (SELECT *, 1 / sqrt(1 + pow((l0 - a) / b, 2)) AS u1, (l0 - a) / b / sqrt(1 + pow((l0 - a) / b, 2)) AS u2 FROM l)
 SELECT l0, l1, CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE sign(u2) END * u1 AS v01, CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE sign(u2) END * u2 AS v02,
 CASE WHEN abs(u2) >= abs(u1) THEN sign(-u2) ELSE sign(u1) END * -u2 AS v11, CASE WHEN abs(u2) >= abs(u1) THEN sign(-u2) ELSE sign(u1) END * u1 AS v12 FROM v)"""


def pair(spark, d):
    return lines(spark, d).select("id", (F.col("qty") / 10).alias("x1"), (F.col("disc") * 10).alias("x2"))


def _sql_component_rows(picks: dict[str, tuple[str, str, str, str]]) -> str:
    """Rows (component, feature, ...) with one expression per row and column."""
    rows = []
    for i, (c, f) in enumerate(((0, "x1"), (0, "x2"), (1, "x1"), (1, "x2"))):
        cols = ", ".join(f"{sql_round(e[i])} AS {name}" for name, e in picks.items())
        rows.append(f"SELECT CAST({c} AS BIGINT) AS component, '{f}' AS feature, {cols} FROM {_EIGEN}")
    return " UNION ALL ".join(rows)


def _component_frame(spark, d, *cols):
    found = decompose.components(pair(spark, d), ["x1", "x2"]).frame(spark, ["x1", "x2"])
    return found.select("component", "feature", *[r(c).alias(c) for c in cols])


@query("d1_eigenpairs", _sql_component_rows({"variance": ("l0", "l0", "l1", "l1"), "weight": ("v01", "v02", "v11", "v12")}))
def d1(spark, d):
    return _component_frame(spark, d, "variance", "weight")


@query("d1_reconstruction", " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS i, CAST({j} AS BIGINT) AS j, {sql_round(f'covar_samp({a}, {b})', 5)} AS value FROM {SQL_LINES.replace('l_extendedprice AS price', 'l_extendedprice / 1000 AS price')}"
    for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES)))
def d1_reconstruction(spark, d):
    """The covariance matrix of four features, put together again from its eigenpairs."""
    rows = lines(spark, d).withColumn("price", F.col("price") / 1000)
    found = decompose.components(rows, FEATURES)
    m = found.vectors @ np.diag(found.values) @ found.vectors.T
    cells = [(i, j, float(m[i, j])) for i in range(4) for j in range(4)]
    return spark.createDataFrame(cells, "i bigint, j bigint, value double").select("i", "j", r("value", 5).alias("value"))


@query(
    "d2_explained_variance",
    f"""SELECT CAST(0 AS BIGINT) AS component, {sql_round('l0 / (l0 + l1)')} AS ratio, {sql_round('l0 / (l0 + l1)')} AS cumulative FROM {_EIGEN}
    UNION ALL SELECT 1, {sql_round('l1 / (l0 + l1)')}, 1.0 FROM {_EIGEN}""",
)
def d2(spark, d):
    return _component_frame(spark, d, "ratio", "cumulative").where("feature = 'x1'").drop("feature")


@query("d3_projection", f"SELECT id, {sql_round('x1 * v01 + x2 * v02')} AS pc0, {sql_round('x1 * v11 + x2 * v12')} AS pc1 FROM {_PAIR}, {_EIGEN}")
def d3(spark, d):
    rows = pair(spark, d)
    scores = decompose.components(rows, ["x1", "x2"]).project(rows, ["x1", "x2"], 2)
    return scores.select("id", r("pc0").alias("pc0"), r("pc1").alias("pc1"))


@query(
    "d4_scaled_pca",
    f"""WITH z AS (SELECT id, (qty - avg(qty) OVER ()) / stddev_samp(qty) OVER () AS a, (price - avg(price) OVER ()) / stddev_samp(price) OVER () AS b FROM {SQL_LINES}),
    c AS (SELECT corr(a, b) AS c FROM z)
    SELECT id, {sql_round('abs(CASE WHEN c > 0 THEN a + b ELSE a - b END) / sqrt(2)', 4)} AS pc0, {sql_round('abs(CASE WHEN c > 0 THEN a - b ELSE a + b END) / sqrt(2)', 4)} AS pc1 FROM z, c""",
)
def d4(spark, d):
    """Absolute scores of two scaled features on their components."""
    rows = columns.to_features(lines(spark, d).select("id", "qty", "price"), ["qty", "price"])
    scored = decompose.scaled_pca(2).fit(rows).transform(rows).withColumn("v", vector_to_array("pca"))
    return scored.select("id", r(F.abs(F.col("v")[0]), 4).alias("pc0"), r(F.abs(F.col("v")[1]), 4).alias("pc1"))


@query(
    "d5_loadings",
    _sql_component_rows({"loading": ("v01 * sqrt(l0)", "v02 * sqrt(l0)", "v11 * sqrt(l1)", "v12 * sqrt(l1)")}),
)
def d5(spark, d):
    return _component_frame(spark, d, "loading")


@query("d4_embedding_pca")
def d4_embeddings(spark, d):
    """Variance along all components of the 64-wide vectors."""
    cov = stats.vector_covariance(table(spark, d, "embeddings"), "embedding", 64)
    found = decompose.eigen(decompose.matrix_of(cov, 64))
    rows = [(i, float(v), float(s)) for i, (v, s) in enumerate(zip(found.values, found.explained()))]
    return spark.createDataFrame(rows, "component bigint, variance double, ratio double").select("component", r("variance").alias("variance"), r("ratio").alias("ratio"))


def _topic_model(spark, d):
    vocab = cut_lineage(pruned(spark, d))
    words = F.coalesce(tx.word_tokens(F.col("text")), F.array().cast("array<string>"))  # a NULL text has no words
    docs = evened(documents(spark, d).select("doc_id", words.alias("tokens")))
    counted = cut_lineage(vectorize.count_vectorizer(vocab, "tokens", "features").transform(docs).select("doc_id", "features"))
    model = decompose.fit_topics(counted, topics=10)
    return model, counted, vocab


@query("d6_topics")
def d6(spark, d):
    """Topic shares of every document."""
    model, counted, _ = _topic_model(spark, d)
    shares = model.transform(counted).select("doc_id", F.posexplode(vector_to_array("topicDistribution")).alias("topic", "share"))
    return shares.select("doc_id", big("topic").alias("topic"), r("share").alias("share"))


@query("d7_top_words")
def d7(spark, d):
    model, _, vocab = _topic_model(spark, d)
    return decompose.top_words(model, vocab, 5).select("topic", "rank", "term", r("weight").alias("weight"))


# ---- workflow --------------------------------------------------------------------------------------


def _chain(k: int = 2) -> Pipeline:
    """Scale, project, classify."""
    return Pipeline(stages=[*decompose.scaled_pca(k).getStages(), classify.logistic(features="pca")])


@query("w1_fitted_chain")
def w1(spark, d):
    train, test = split_rows(spark, d)
    return test_scores(_chain().fit(train), test)


@query("w2_function_chain")
def w2(spark, d):
    """The same steps chained with DataFrame.transform; equal scores."""
    train, test = split_rows(spark, d)
    scale, project = _chain().getStages()[:2]
    scaled = scale.fit(train)
    projected = project.fit(train.transform(scaled.transform))
    model = classify.logistic(features="pca").fit(train.transform(scaled.transform).transform(projected.transform))
    scored = test.transform(scaled.transform).transform(projected.transform).transform(model.transform)
    auc = BinaryClassificationEvaluator(numBins=0).evaluate(scored)
    return scored.agg(F.count(F.lit(1)).alias("n"), r(metrics.accuracy("label", "prediction")).alias("accuracy"), r(F.lit(auc)).alias("auc"))


def folded_rows(spark, d, k):
    """(label, features, fold), written once."""
    rows = sampling.stratified_folds(noisy_lines(spark, d).select("id", "label", *FEATURES), "id", "label", k, seed=2)
    kept = written(evened(rows.select("label", *FEATURES, "fold")))
    return columns.to_features(kept, FEATURES).select("label", "features", "fold")


def _accuracy(scored) -> float:
    return scored.agg(metrics.accuracy("label", "prediction")).first()[0]


def _auc(scored) -> float:
    return BinaryClassificationEvaluator(numBins=0).evaluate(scored)


def folded_parts(spark, d, k, names=("x0", "x1")):
    """All parts with a noisy label on their size, dealt to folds; ``names`` of size (x0) and price (x1) are the features."""
    label = ((F.col("p_size") > 20) != uniform_below(9, 0.1, "p_partkey")).cast("double")
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x0"), F.col("p_retailprice").alias("x1"), label.alias("label"))
    return evened(columns.to_features(sampling.stratified_folds(parts, "id", "label", k, seed=2), list(names)).select("id", "label", "features", "fold"))


def vote_members() -> dict:
    """A scaled logistic regression, a stump, scaled nearest neighbours, and their vote."""
    chain = Pipeline(stages=[scaler(), classify.logistic(features="scaled")])
    stump = ensemble.decision_tree(max_depth=1, maxBins=64)
    near = Pipeline(stages=[scaler(), estimators.NearestNeighbours(k=1, key="id", features="scaled")])
    members = [("logistic", chain), ("tree", stump), ("neighbours", near)]
    return dict(members) | {"vote": estimators.SoftVote(members)}


@query("w4_cross_val_scores")
def w4(spark, d):
    """ROC area in ten folds of three learners and their vote."""
    scores = select.fold_scores(cut_lineage(folded_parts(spark, d, 10)), vote_members(), "fold", 10, _auc, train_score=False)
    return scores.select("setting", "fold", r("valid").alias("auc"))


@query("w5_learning_curve_classifier")
def w5_classifier(spark, d):
    sizes = [k / 10 for k in range(1, 11)]
    curve = select.learning_curve(cut_lineage(folded_parts(spark, d, 10)), "id", classify.logistic(), "fold", 10, sizes, _accuracy, seed=4)
    return curve.select("size", "fold", r("train").alias("train"), r("valid").alias("valid"))


@query("w6_validation_curve_classifier")
def w6_classifier(spark, d):
    """Mean and spread of the accuracy for six penalties."""
    chains = {float(p): Pipeline(stages=[scaler(), classify.logistic(l2=p, features="scaled")]) for p in (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)}
    scores = select.fold_scores(cut_lineage(folded_parts(spark, d, 10)), chains, "fold", 10, _accuracy)
    return scores.groupBy(F.col("setting").alias("l2")).agg(
        *[r(f(c)).alias(f"{c}_{n}") for c in ("train", "valid") for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
    )


def _svm_search(spark, d, search, **kw):
    svc = classify.SupportVectorClassifier(featuresCol="scaled", maxIter=10, size=16)
    linear = ParamGridBuilder().addGrid(svc.kernel, ["linear"]).addGrid(svc.C, [1.0, 100.0]).build()
    rbf = ParamGridBuilder().addGrid(svc.kernel, ["rbf"]).addGrid(svc.C, [1.0, 100.0]).addGrid(svc.gamma, [0.1, 1.0]).build()
    rows = folded_rows(spark, d, 3)
    return search(
        rows, Pipeline(stages=[scaler(), svc]), [linear, rbf], MulticlassClassificationEvaluator(metricName="accuracy"), "fold", 3, **kw
    )


@query("w7_grid_search")
def w7(spark, d):
    """A union of two grids over a scaled support vector classifier."""
    return _svm_search(spark, d, select.grid_search).table


@query("w8_random_search")
def w8(spark, d):
    return _svm_search(spark, d, select.random_search, n_iter=3, seed=1).table


@query("w9_text_classifier")
def w9(spark, d):
    """TF-IDF of cleaned documents and a logistic regression on their quality label."""
    labelled = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    docs = documents(spark, d).join(labelled, "doc_id")
    words = tx.without_stop_words(tx.tokens(tx.clean(F.col("text"))))
    rows = cut_lineage(sampling.stratified_split(docs.select("doc_id", "label", words.alias("tokens")), "doc_id", "label", 0.3, seed=1))
    train, test = rows.where(~F.col("is_test")), rows.where("is_test")
    fit = vectorize.fit_tfidf(train, F.col("tokens"))
    vocab = cut_lineage(ordered_rank(fit.terms, ["term"], "_rn").select("term", "df", (F.col("_rn") - 1).alias("idx")))

    def vectors(side):
        weights = fit.transform(vectorize.term_counts(side, "doc_id", F.col("tokens")), "doc_id")
        return cut_lineage(vectorize.sparse_vectors(side.select("doc_id", "label"), weights, vocab, "doc_id"))

    model = wide.WideLogistic(l2=1e-4, max_iter=50).fit(vectors(train))
    return test_scores(model, vectors(test))
