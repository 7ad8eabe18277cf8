"""Queries whose answer SQL can state too, for learners whose full-size runs it cannot."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomstat.functions import text as tx
from loomstat.operators import classify, cluster, columns, encode, ensemble, sampling, select, vectorize
from loomstat.operators.ordering import ordered_rank
from loomstat.plans.learners import _TREE_ROWS, _auc, _topic_model, _sql_tree, _tree_rows, folded_parts, noisy_lines, _SQL_NOISY
from loomstat.plans.regression import _TWO_SUMS, two_features
from loomstat.plans.registry import ORACLES, big, query, r, sql_round, sql_uniform
from loomstat.plans.text import _WORD_TOKENS, _KEPT_TOKENS, documents
from loomstat.session import cut_lineage
from loomstat.sources.tables import table

# ---- one tree of depth one ----------------------------------------------------------

_LEAVES = _sql_tree(_TREE_ROWS, "({s} - {s} * {s} / {n})", sql_round("avg(y)"))


def _leaves(scored, value):
    return scored.withColumn("value", value).groupBy("value").agg(F.count(F.lit(1)).alias("n")).select(r("value").alias("value"), "n")


@query("c9_one_tree", _LEAVES)
def c9_tree(spark, d):
    """A forest of one tree that sees all rows and features is that tree."""
    rows = _tree_rows(spark, d)
    forest = RandomForestClassifier(numTrees=1, maxDepth=1, maxBins=64, bootstrap=False, featureSubsetStrategy="all", seed=1)
    return _leaves(forest.fit(rows).transform(rows), columns.class_probability(1))


@query("c13_one_member", _LEAVES)
def c13_member(spark, d):
    rows = _tree_rows(spark, d)
    return _leaves(ensemble.bagged_trees(1, bootstrap=False, max_depth=1, maxBins=64).fit(rows).transform(rows), columns.class_probability(1))


_TARGET = "(SELECT CAST(p_size AS DOUBLE) AS size, abs(p_size - 17) * 1.0 + p_retailprice / 100 AS y FROM part)"


@query("r9_one_tree", _sql_tree(_TARGET, "({q} - {s} * {s} / {n})", sql_round("avg(y)")))
def r9_tree(spark, d):
    label = F.abs(F.col("p_size") - 17) * 1.0 + F.col("p_retailprice") / 100
    rows = columns.to_features(table(spark, d, "part").withColumn("label", label), ["p_size"])
    forest = RandomForestRegressor(numTrees=1, maxDepth=1, maxBins=64, bootstrap=False, featureSubsetStrategy="all", seed=1)
    return _leaves(forest.fit(rows).transform(rows), F.col("prediction"))


_SIGNED = f"(SELECT size, 2 * y - 1 AS y FROM {_TREE_ROWS})"


@query("c16_one_round", _sql_tree(_SIGNED, "({q} - {s} * {s} / {n})", sql_round("avg(y)")))
def c16_round(spark, d):
    """One boosting round is a regression stump on labels of -1 and 1."""
    rows = _tree_rows(spark, d)
    scored = GBTClassifier(maxIter=1, maxDepth=1, maxBins=64, seed=1).fit(rows).transform(rows)
    return _leaves(scored, vector_to_array("rawPrediction")[1])


# ---- three rounds of adaptive boosting --------------------------------------------------


def _sql_boosting(rounds: int) -> str:
    parts = [f"w0 AS MATERIALIZED (SELECT size, y, count(*) * 1.0 AS w FROM {_TREE_ROWS} GROUP BY 1, 2)"]
    for k in range(rounds):
        cost = "{a} * {b} / ({a} + {b})"
        left, right = cost.format(a="l0", b="l1"), cost.format(a="(t0 - l0)", b="(t1 - l1)")
        parts += [
            f"g{k} AS (SELECT size, sum(w) FILTER (y = 0) AS a, sum(w) FILTER (y = 1) AS b FROM w{k} GROUP BY 1)",
            f"""c{k} AS (SELECT size, sum(coalesce(a, 0)) OVER o AS l0, sum(coalesce(b, 0)) OVER o AS l1, sum(coalesce(a, 0)) OVER () AS t0, sum(coalesce(b, 0)) OVER () AS t1
            FROM g{k} WINDOW o AS (ORDER BY size))""",
            f"b{k} AS MATERIALIZED (SELECT * FROM c{k} WHERE l0 + l1 < t0 + t1 ORDER BY {left} + {right}, size LIMIT 1)",
            f"""p{k} AS (SELECT w{k}.size, y, w, CASE WHEN w{k}.size <= b{k}.size THEN l1 > l0 ELSE t1 - l1 > t0 - l0 END <> (y = 1) AS wrong FROM w{k}, b{k})""",
            f"e{k} AS MATERIALIZED (SELECT coalesce(sum(w) FILTER (wrong), 0) / sum(w) AS e FROM p{k})",
            f"w{k + 1} AS MATERIALIZED (SELECT size, y, w * exp(CASE WHEN wrong THEN 1 ELSE -1 END * 0.5 * ln((1 - e) / e)) AS w FROM p{k}, e{k})",
        ]
    rows = " UNION ALL ".join(f"SELECT CAST({k + 1} AS BIGINT) AS round, {sql_round('e', 7)} AS error, {sql_round('0.5 * ln((1 - e) / e)', 7)} AS alpha FROM e{k}" for k in range(rounds))
    return f"WITH {', '.join(parts)} {rows}"


@query("c14_three_rounds", _sql_boosting(3))
def c14_rounds(spark, d):
    """Errors and weights of three boosted stumps."""
    rows = _tree_rows(spark, d).select("features", "label")
    model = ensemble.adaboost(rows, ensemble.decision_tree(max_depth=1, maxBins=64), n_estimators=3)
    out = [(i + 1, float(e), float(a)) for i, (e, a) in enumerate(zip(model.errors, model.alphas))]
    frame = spark.createDataFrame(out, "round bigint, error double, alpha double")
    return frame.select("round", r("error", 7).alias("error"), r("alpha", 7).alias("alpha"))


# ---- far groups -------------------------------------------------------------------------

_GROUPS = """(SELECT o_orderkey AS id, o_custkey % 3 AS g, o_custkey % 3 * 100.0 + o_orderkey % 7 AS x1, o_custkey % 3 * 50.0 + o_orderkey % 5 AS x2 FROM orders)"""
_GROUP_ROWS = f"""SELECT row_number() OVER (ORDER BY avg(x1)) - 1 AS cluster, count(*) AS n, {sql_round('avg(x1)')} AS x1, {sql_round('avg(x2)')} AS x2,
 {sql_round('(var_pop(x1) + var_pop(x2)) * count(*)', 3)} AS inertia FROM {_GROUPS} GROUP BY g"""


def far_groups(spark, d):
    x1 = (F.col("o_custkey") % 3 * 100 + F.col("o_orderkey") % 7).cast("double")
    x2 = (F.col("o_custkey") % 3 * 50 + F.col("o_orderkey") % 5).cast("double")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), x1.alias("x1"), x2.alias("x2"))


def _found(spark, d, init):
    rows = far_groups(spark, d)
    fit = cluster.kmeans(rows.select("id", F.array("x1", "x2").alias("vec")), "id", "vec", 3, init=init, n_init=10)
    placed = cluster.with_nearest(rows, ["x1", "x2"], fit.centres[fit.centres[:, 0].argsort()])
    return placed.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), r(F.avg("x1")).alias("x1"), r(F.avg("x2")).alias("x2"), r(F.sum("d2"), 3).alias("inertia")
    )


@query("k1_far_groups", _GROUP_ROWS)
def k1_groups(spark, d):
    """The best of ten random starts finds groups that lie far apart."""
    return _found(spark, d, "random")


@query("k2_far_groups", _GROUP_ROWS)
def k2_groups(spark, d):
    return _found(spark, d, "k-means++")


@query("k4_far_groups", f"SELECT CAST(3 AS BIGINT) AS k, {sql_round('sum(inertia)', 3)} AS inertia FROM ({_GROUP_ROWS.replace(', 3)', ', 9)')})")
def k4_groups(spark, d):
    rows = far_groups(spark, d).select("id", F.array("x1", "x2").alias("vec"))
    return cluster.elbow(rows, "id", "vec", [3]).select("k", r("inertia", 3).alias("inertia"))


@query("k7_far_groups", f"SELECT cluster, n FROM ({_GROUP_ROWS})")
def k7_groups(spark, d):
    """Complete linkage of nine micro-clusters puts the groups together again."""
    rows = columns.to_features(far_groups(spark, d), ["x1", "x2"])
    placed, _ = cluster.agglomerate(rows, 3, micro=9)
    found = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("x1").alias("x"))
    return ordered_rank(found, ["x"], "rn").select((F.col("rn") - 1).alias("cluster"), "n")


# ---- chains ---------------------------------------------------------------------------------

_CHAIN = f"""SELECT n, {sql_round('yy - u * (c * u - b * v) / (a * c - b * b) - v * (a * v - b * u) / (a * c - b * b)', 5)} AS mse FROM (SELECT *, (SELECT var_pop(price / 1000) FROM lines) AS yy FROM {_TWO_SUMS})"""
_CHAIN_SQL = "WITH lines AS (SELECT l_extendedprice AS price FROM lineitem) " + _CHAIN


def _chain():
    scale = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    project = PCA(k=2, inputCol="scaled", outputCol="pca")
    return scale, project, LinearRegression(featuresCol="pca", labelCol="y", regParam=0.0)


def _score(scored):
    return scored.agg(F.count(F.lit(1)).alias("n"), r(F.avg(F.pow(F.col("y") - F.col("prediction"), 2)), 5).alias("mse"))


@query("w1_projected_least_squares", _CHAIN_SQL)
def w1_squares(spark, d):
    """Scaled and projected on all components, least squares is least squares."""
    rows = columns.to_features(two_features(spark, d), ["x1", "x2"])
    return _score(Pipeline(stages=[*_chain()]).fit(rows).transform(rows))


@query("w2_projected_least_squares", _CHAIN_SQL)
def w2_squares(spark, d):
    """The same chain by DataFrame.transform."""
    rows = columns.to_features(two_features(spark, d), ["x1", "x2"])
    for stage in _chain():
        rows = rows.transform(stage.fit(rows).transform)
    return _score(rows)


# ---- optima ---------------------------------------------------------------------------------

_L2 = 0.1


@query(
    "c7_penalised_optimum",
    f"""SELECT {sql_round('avg(z * label)', 4)} AS balance, {sql_round('avg(label)', 5)} AS mean_p
    FROM (SELECT label, (price - avg(price) OVER ()) / stddev_samp(price) OVER () AS z FROM {_SQL_NOISY})""",
)
def c7_optimum(spark, d):
    """At the penalised optimum mean(z p) + l2 w is mean(z y), and mean(p) is mean(y)."""
    rows = columns.to_features(encode.standardised(noisy_lines(spark, d).select("label", "price"), ["price"]), ["price"])
    base = classify.logistic(l2=_L2, max_iter=200)
    model = base.copy({base.tol: 1e-10}).fit(rows)
    p = columns.class_probability(1)
    weight = float(model.coefficients[0])
    return model.transform(rows).agg(r(F.avg(F.col("price") * p) + F.lit(_L2 * weight), 4).alias("balance"), r(F.avg(p), 5).alias("mean_p"))


# ---- texts ------------------------------------------------------------------------------------


@query("t9_totals", f"SELECT CAST(count(*) AS BIGINT) AS tokens, count(DISTINCT term) AS terms FROM (SELECT unnest({_WORD_TOKENS}) AS term FROM documents)")
def t9_totals(spark, d):
    """Stemming moves tokens and terms between rows, and loses none."""
    stems = vectorize.stem_counts(documents(spark, d), tx.word_tokens(F.col("text")))
    return stems.agg(F.sum("n").alias("tokens"), F.sum("terms").alias("terms"))


_PRUNED = f"""(SELECT term FROM (SELECT term, count(*) AS df, sum(tf) AS cf FROM (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_KEPT_TOKENS}) AS term FROM documents) GROUP BY 1, 2) GROUP BY 1)
 WHERE df <= 0.1 * (SELECT count(*) FROM documents) ORDER BY cf DESC, term LIMIT 5000)"""


@query(
    "d6_share_sums",
    f"""SELECT d.doc_id, CAST(least(count(p.term), 1) AS DOUBLE) AS share, CAST(count(p.term) AS BIGINT) AS tokens FROM documents d
    LEFT JOIN (SELECT doc_id, unnest({_WORD_TOKENS}) AS term FROM documents) t ON t.doc_id = d.doc_id LEFT JOIN {_PRUNED} p ON p.term = t.term GROUP BY 1""",
)
def d6_sums(spark, d):
    """Topic shares sum to one (to zero without known tokens); a vector counts a document's tokens that are in the vocabulary."""
    model, counted, _ = _topic_model(spark, d)
    total = lambda c: F.aggregate(vector_to_array(c), F.lit(0.0), lambda a, b: a + b)
    return model.transform(counted).select("doc_id", r(total("topicDistribution"), 5).alias("share"), big(total("features")).alias("tokens"))


@query("d7_word_ranks", f"SELECT term, CAST(10 AS BIGINT) AS topics, df AS documents FROM ({ORACLES['t13_pruned_vocabulary']})")
def d7_ranks(spark, d):
    """Each topic ranks every word of the vocabulary once, the heaviest first; with the documents that hold the word."""
    from loomstat.operators import decompose

    model, _, vocab = _topic_model(spark, d)
    words = decompose.top_words(model, vocab, 5000)
    before = F.lag("weight").over(Window.partitionBy("topic").orderBy("rank"))
    in_order = words.withColumn("falling", F.coalesce(before >= F.col("weight"), F.lit(True))).where("falling")
    return in_order.groupBy("term").agg(F.count_distinct("topic").alias("topics")).join(vocab.select("term", F.col("df").alias("documents")), "term")


# ---- folds and searches -----------------------------------------------------------------------

_FOLDED = f"""(SELECT *, (row_number() OVER (PARTITION BY y ORDER BY md5('2:'||p_partkey)) - 1) % 10 AS fold
 FROM (SELECT *, CAST((p_size > 20) <> ({sql_uniform(9, 'p_partkey')} < 0.1) AS DOUBLE) AS y FROM part))"""


@query(
    "w4_stump_folds",
    f"""WITH t AS {_FOLDED}, g AS (SELECT fold, p_size, count(*) AS n, sum(y) AS s FROM t GROUP BY 1, 2),
    k AS (SELECT DISTINCT fold AS k FROM g),
    i AS (SELECT k, p_size, sum(n) AS n, sum(s) AS s FROM k JOIN g ON fold <> k GROUP BY 1, 2),
    c AS (SELECT k, p_size, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER (PARTITION BY k) AS n, sum(s) OVER (PARTITION BY k) AS s FROM i WINDOW w AS (PARTITION BY k ORDER BY p_size)),
    b AS (SELECT * FROM c WHERE ln < n QUALIFY row_number() OVER (PARTITION BY k ORDER BY ls - ls * ls / ln + (s - ls) - (s - ls) * (s - ls) / (n - ln), p_size) = 1),
    v AS (SELECT k, any_value(b.ls > b.s - b.ls) AS turned, sum(g.s) FILTER (g.p_size > b.p_size) AS p1, sum(g.s) AS p, sum(g.n - g.s) FILTER (g.p_size > b.p_size) AS n1, sum(g.n - g.s) AS n
      FROM b JOIN g ON fold = k GROUP BY k),
    a AS (SELECT k, turned, (p1 * (n - n1) + 0.5 * (p1 * n1 + (p - p1) * (n - n1))) / (p * n) AS auc FROM v)
    SELECT 'tree' AS setting, CAST(k AS BIGINT) AS fold, {sql_round('CASE WHEN turned THEN 1 - auc ELSE auc END')} AS auc FROM a""",
)
def w4_stumps(spark, d):
    """ROC area in ten folds of a tree of depth one."""
    rows = cut_lineage(folded_parts(spark, d, 10, ["x0"]))
    scores = select.fold_scores(rows, {"tree": ensemble.decision_tree(max_depth=1, maxBins=64)}, "fold", 10, _auc, train_score=False)
    return scores.select("setting", "fold", r("valid").alias("auc"))


def _sql_ridge_search(l2s: list[float], draws: str) -> str:
    """Five-fold errors of one-column ridge fits, (params, mean, std, best, refitted).

    Spark's solver works on a label scaled to unit deviation, so a penalty acts as ``l2 / sd(y)`` on the plain one.
    """
    values = ", ".join(f"({i}, {v!r})" for i, v in enumerate(l2s))
    slope = "(xy / n - x / n * y / n) / (xx / n - x / n * x / n + l2 / sqrt(yy / n - y / n * y / n))"
    error = "({0}yy - 2 * w * {0}xy + w * w * {0}xx) / {0}n + c * c - 2 * c * {0}y / {0}n + 2 * c * w * {0}x / {0}n"
    sums = "CAST(count(*) AS DOUBLE) AS n, sum(x) AS x, sum(y) AS y, sum(x * x) AS xx, sum(x * y) AS xy, sum(y * y) AS yy"
    names = ("n", "x", "y", "xx", "xy", "yy")
    return f"""WITH t AS (SELECT CAST(p_size AS DOUBLE) AS x, abs(p_size - 17) + p_retailprice / 100 AS y,
      (row_number() OVER (PARTITION BY p_size > 20 ORDER BY md5('3:'||p_partkey)) - 1) % 5 AS fold FROM part),
    l AS (SELECT i, CAST(l2 AS DOUBLE) AS l2 FROM (VALUES {values}) v(i, l2) {draws}),
    f AS (SELECT fold, {sums} FROM t GROUP BY 1), a AS (SELECT {sums} FROM t),
    j AS (SELECT l2, {', '.join(f'a.{c} - f.{c} AS {c}, f.{c} AS v{c}' for c in names)} FROM l, a, f
      UNION ALL SELECT l2, {', '.join(f'a.{c}, CAST(NULL AS DOUBLE)' for c in names)} FROM l, a),
    w AS (SELECT *, {slope} AS w, y / n - x / n * {slope} AS c FROM j),
    e AS (SELECT l2, avg({error.format('v')}) AS mean, stddev_pop({error.format('v')}) AS std, max({error.format('')}) FILTER (vn IS NULL) AS refitted FROM w GROUP BY 1)
    SELECT 'regParam=' || l2 AS params, {sql_round('mean', 4)} AS mean, {sql_round('std', 4)} AS std,
      mean = min(mean) OVER () AS best, CASE WHEN mean = min(mean) OVER () THEN {sql_round('refitted', 4)} END AS refitted FROM e"""


def _ridge_search(spark, d, search, cuts, **kw):
    """A search over penalties; the best setting is marked and its refitted model scored on all rows."""
    label = F.abs(F.col("p_size") - 17) + F.col("p_retailprice") / 100
    parts = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_size") > 20).alias("large"), label.alias("label"))
    rows = cut_lineage(columns.to_features(sampling.stratified_folds(parts, "p_partkey", "large", 5, seed=3), ["x"]).select("features", "label", "fold"))
    line = LinearRegression(solver="normal", standardization=False)
    grids = [ParamGridBuilder().addGrid(line.regParam, list(cut)).build() for cut in cuts]
    mse = RegressionEvaluator(metricName="mse")
    found = search(rows, line, grids, mse, "fold", 5, **kw)
    best = F.col("params") == f"regParam={found.best_params['regParam']}"
    refitted = F.when(best, F.lit(float(mse.evaluate(found.best_model.transform(rows)))))
    return found.table.select("params", r("mean", 4).alias("mean"), r("std", 4).alias("std"), best.alias("best"), r(refitted, 4).alias("refitted"))


_PENALTIES = [0.5 * k for k in range(20)]


@query("w7_ridge_grid", _sql_ridge_search([0.0, 1.0, 10.0, 0.5, 100.0], ""))
def w7_ridge(spark, d):
    """A union of two grids in five folds."""
    return _ridge_search(spark, d, select.grid_search, [(0.0, 1.0, 10.0), (0.5, 100.0)])


@query("w8_ridge_draws", _sql_ridge_search(_PENALTIES, "ORDER BY md5('1:'||i) LIMIT 10"))
def w8_ridge(spark, d):
    """Ten of twenty settings in five folds."""
    return _ridge_search(spark, d, select.random_search, [_PENALTIES], n_iter=10, seed=1)
