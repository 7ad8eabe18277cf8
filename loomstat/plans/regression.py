"""Regression queries: least squares and its kin, curves, and model selection by Gram matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.operators import encode, linear, metrics, sampling, select
from loomstat.plans.registry import SQL_LINES, big, lines, query, r, sql_hash, sql_round, sql_uniform
from loomstat.plans.tabular import _SQL_SPLIT, split_lines
from loomstat.session import cut_lineage
from loomstat.sources.tables import table


@query(
    "w0_split_scale_fit_score",
    f"""WITH t AS {_SQL_SPLIT}, s AS (SELECT avg(qty) m, stddev_samp(qty) s FROM t WHERE NOT is_test),
    z AS (SELECT is_test, (qty - m) / s AS x, price AS y FROM t, s),
    f AS (SELECT regr_slope(y, x) w, regr_intercept(y, x) b FROM z WHERE NOT is_test),
    p AS (SELECT is_test, y, b + w * x AS p, avg(y) OVER (PARTITION BY is_test) AS my FROM z, f)
    SELECT is_test, count(*) AS n, {sql_round('avg(pow(y - p, 2))', 2)} AS mse, {sql_round('avg(abs(y - p))', 4)} AS mae,
    {sql_round('1 - sum(pow(y - p, 2)) / sum(pow(y - my, 2))', 9)} AS r2 FROM p GROUP BY 1""",
)
def w0(spark, d):
    """Stratified split, standardise on the training rows, least squares, scores per split."""
    rows = cut_lineage(split_lines(spark, d).select("is_test", "qty", "price"))
    train = rows.where(~F.col("is_test"))
    scaler = encode.fit_standard_scaler(train, ["qty"])
    fit = linear.gram(scaler.transform(train), ["qty"], "price").least_squares()
    scored = scaler.transform(rows).withColumn("prediction", fit.score(["qty"]))
    out = metrics.regression_scores(scored, "price", "prediction", by=["is_test"])
    return out.select("is_test", "n", r("mse", 2).alias("mse"), r("mae", 4).alias("mae"), r("r2", 9).alias("r2"))


_Z = f"(SELECT (qty - avg(qty) OVER ()) / stddev_samp(qty) OVER () AS x, (price - avg(price) OVER ()) / stddev_samp(price) OVER () AS y FROM {SQL_LINES})"


def _sql_descent(source: str, eta: float, steps: int) -> str:
    """Batch gradient descent on one feature from its five sums."""
    return f"""WITH RECURSIVE m AS MATERIALIZED (SELECT avg(x) mx, avg(y) my, avg(x * x) mxx, avg(x * y) mxy, avg(y * y) myy FROM {source}),
    g(step, b, w, loss) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE) UNION ALL
    SELECT step + 1, b - {eta} * 2 * (b + w * mx - my), w - {eta} * 2 * (b * mx + w * mxx - mxy),
    b * b + 2 * b * w * mx + w * w * mxx - 2 * b * my - 2 * w * mxy + myy FROM g, m WHERE step < {steps})"""


def losses_frame(spark, fit):
    return spark.createDataFrame([(i + 1, float(x)) for i, x in enumerate(fit.losses)], "epoch bigint, loss double")


@query("r1_gradient_descent", _sql_descent(_Z, 0.1, 20) + f" SELECT {sql_round('b', 9)} AS b, {sql_round('w', 9)} AS w FROM g WHERE step = 20")
def r1(spark, d):
    z = encode.standardised(lines(spark, d).select("qty", "price"), ["qty", "price"])
    fit = linear.gradient_descent(linear.gram(z, ["qty"], "price"), eta=0.1, num_iter=20)
    return fit.frame(spark, ["w"]).groupBy().pivot("term", ["b", "w"]).agg(r(F.first("value"), 9))


@query(
    "c2_adaline_batch",
    _sql_descent(f"(SELECT (qty - avg(qty) OVER ()) / stddev_samp(qty) OVER () AS x, CAST(flag = 'R' AS DOUBLE) AS y FROM {SQL_LINES})", 0.25, 15)
    + f" SELECT CAST(step AS BIGINT) AS epoch, {sql_round('loss', 9)} AS loss FROM g WHERE step > 0",
)
def c2(spark, d):
    """Loss per epoch of a linear unit trained by full-batch descent."""
    rows = encode.standardised(lines(spark, d).select("qty", "flag"), ["qty"])
    rows = rows.select("qty", (F.col("flag") == "R").cast("double").alias("y"))
    fit = linear.gradient_descent(linear.gram(rows, ["qty"], "y"), eta=0.25, num_iter=15)
    return losses_frame(spark, fit).select("epoch", r("loss", 9).alias("loss"))


def _sql_minibatch(source: str, eta: float, batches: int, epochs: int) -> str:
    return f"""WITH RECURSIVE m AS MATERIALIZED (SELECT batch, avg(x) mx, avg(y) my, avg(x * x) mxx, avg(x * y) mxy FROM {source} GROUP BY 1),
    g(step, b, w) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) UNION ALL
    SELECT step + 1, b - {eta} * 2 * (b + w * mx - my), w - {eta} * 2 * (b * mx + w * mxx - mxy)
    FROM g JOIN m ON m.batch = step % {batches} WHERE step < {batches * epochs})"""


@query(
    "c3_adaline_stochastic",
    _sql_minibatch(
        f"""(SELECT (qty - avg(qty) OVER ()) / stddev_samp(qty) OVER () AS x, CAST(flag = 'R' AS DOUBLE) AS y,
        CAST(floor({sql_uniform(1, 'id')} * 16) AS INT) AS batch FROM {SQL_LINES})""", 0.01, 16, 15)
    + f" SELECT {sql_round('b', 9)} AS b, {sql_round('w', 9)} AS w FROM g WHERE step = 240",
)
def c3(spark, d):
    """Weights after 15 epochs of 16 seeded mini-batches, from one pass over the rows."""
    rows = encode.standardised(lines(spark, d).select("id", "qty", "flag"), ["qty"])
    rows = rows.select("id", "qty", (F.col("flag") == "R").cast("double").alias("y"))
    fit = linear.minibatch_descent(linear.hashed_batches(rows, "id", ["qty"], "y", 16, seed=1), eta=0.01, num_iter=15)
    return fit.frame(spark, ["w"]).groupBy().pivot("term", ["b", "w"]).agg(r(F.first("value"), 9))


@query("r2_least_squares", f"SELECT {sql_round('regr_intercept(price, qty)', 4)} AS b, {sql_round('regr_slope(price, qty)', 6)} AS w FROM {SQL_LINES}")
def r2(spark, d):
    return lines(spark, d).agg(r(F.regr_intercept("price", "qty"), 4).alias("b"), r(F.regr_slope("price", "qty")).alias("w"))


# Two standardised features x1, x2 and a target y, with the sums that SQL needs.
_TWO = f"(SELECT qty / 10 AS x1, disc * 10 AS x2, price / 1000 AS y FROM {SQL_LINES})"
_TWO_SUMS = f"""(SELECT avg(x1) m1, avg(x2) m2, avg(y) my, var_pop(x1) a, var_pop(x2) c, covar_pop(x1, x2) b,
 covar_pop(x1, y) u, covar_pop(x2, y) v, count(*) n FROM {_TWO})"""


def two_features(spark, d):
    return lines(spark, d).select((F.col("qty") / 10).alias("x1"), (F.col("disc") * 10).alias("x2"), (F.col("price") / 1000).alias("y"))


def _fit_row(spark, fit, digits=6):
    return fit.frame(spark, ["w1", "w2"]).groupBy().pivot("term", ["b", "w1", "w2"]).agg(r(F.first("value"), digits))


def _sql_two(l2: str) -> str:
    """Closed form for two features with ``l2`` added to the mean squares."""
    det = f"((a + {l2}) * (c + {l2}) - b * b)"
    w1, w2 = f"((c + {l2}) * u - b * v) / {det}", f"((a + {l2}) * v - b * u) / {det}"
    return f"""SELECT {sql_round(f'my - m1 * ({w1}) - m2 * ({w2})')} AS b, {sql_round(w1)} AS w1, {sql_round(w2)} AS w2 FROM {_TWO_SUMS}"""


@query("r2_least_squares_many", _sql_two("0"))
def r2_many(spark, d):
    return _fit_row(spark, linear.gram(two_features(spark, d), ["x1", "x2"], "y").least_squares())


@query("r5_ridge", _sql_two("100.0 / n"))
def r5(spark, d):
    return _fit_row(spark, linear.gram(two_features(spark, d), ["x1", "x2"], "y").least_squares(l2=100.0))


def _sql_coordinate(l1: float, l2: float, rounds: int = 30) -> str:
    """Coordinate descent with soft thresholding on the two features' sums."""

    def soft(rho, square):
        return f"sign({rho}) * greatest(abs({rho}) - {l1}, 0) / ({square} + {l2})"

    first = soft("(u - b * w2)", "a")
    return f"""WITH RECURSIVE m AS {_TWO_SUMS}, g(step, w1, w2) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) UNION ALL
    SELECT step + 1, n1, {soft('(v - b * n1)', 'c')} FROM (SELECT *, {first} AS n1 FROM g, m) WHERE step < {rounds})
    SELECT {sql_round('my - m1 * w1 - m2 * w2')} AS b, {sql_round('w1')} AS w1, {sql_round('w2')} AS w2 FROM g, m WHERE step = {rounds}"""


@query("r4_lasso", _sql_coordinate(0.05, 0.0))
def r4(spark, d):
    return _fit_row(spark, linear.lasso(linear.gram(two_features(spark, d), ["x1", "x2"], "y"), alpha=0.05))


@query("r6_elastic_net", _sql_coordinate(0.05, 0.05))
def r6(spark, d):
    return _fit_row(spark, linear.elastic_net(linear.gram(two_features(spark, d), ["x1", "x2"], "y"), alpha=0.1, l1_ratio=0.5))


_TRIALS = 100
_TURNS = ", ".join(f"(CAST({t} AS BIGINT), CAST({a} AS HUGEINT), CAST({c} AS HUGEINT))" for t, (a, c) in enumerate(linear.trial_turns(_TRIALS)))
_RANSAC = f"""(WITH l AS {SQL_LINES}, h AS MATERIALIZED (SELECT price, qty, CAST('0x' || substr(md5('123:' || id), 1, 13) AS HUGEINT) AS h FROM l),
 t AS (SELECT * FROM (VALUES {_TURNS}) AS t(trial, factor, shift)),
 f AS (SELECT trial, regr_intercept(price, qty) AS b, regr_slope(price, qty) AS w FROM h, t WHERE (h * factor + shift) % 4503599627370496 < {round(0.95 * 2**52)} GROUP BY 1),
 i AS (SELECT trial, count_if(abs(price - (b + w * qty)) <= 25000) AS inliers, any_value(b) AS b, any_value(w) AS w FROM l, f GROUP BY 1)
 SELECT * FROM i)"""


@query(
    "r3_ransac",
    f"""WITH best AS (SELECT * FROM {_RANSAC} ORDER BY inliers DESC, trial LIMIT 1)
    SELECT trial, CAST(inliers AS BIGINT) AS inliers, {sql_round('regr_intercept(price, qty)', 4)} AS b, {sql_round('regr_slope(price, qty)')} AS w
    FROM (SELECT best.trial, best.inliers, price, qty FROM {SQL_LINES}, best WHERE abs(price - (best.b + best.w * qty)) <= 25000) GROUP BY 1, 2""",
)
def r3(spark, d):
    """The line with most inliers out of 100 trials, fitted again on its inliers."""
    found = linear.ransac(lines(spark, d), "id", "qty", "price", _TRIALS, 0.95, 25000, seed=123)
    rows = [(found.best_trial, found.inliers, float(found.fit.b), float(found.fit.w[0]))]
    frame = spark.createDataFrame(rows, "trial bigint, inliers bigint, b double, w double")
    return frame.select("trial", "inliers", r("b", 4).alias("b"), r("w").alias("w"))


@query("j7_rows_by_candidates", f"SELECT trial, CAST(inliers AS BIGINT) AS inliers FROM {_RANSAC}")
def j7(spark, d):
    """Every row against every candidate line."""
    rows = lines(spark, d)
    fits = linear.trial_fits(rows, "id", "qty", "price", _TRIALS, 0.95, seed=123)
    counts = linear.inlier_counts(rows, "qty", "price", fits, 25000)
    return spark.createDataFrame(list(enumerate(counts)), "trial bigint, inliers bigint")


def _sql_polynomial(degree: int) -> str:
    """r2 of a polynomial in z = (qty - 25) / 25 by Gram-Schmidt on the powers."""
    ctes = [f"q0 AS (SELECT z - avg(z) OVER () AS e1, z * z - avg(z * z) OVER () AS p2, z * z * z - avg(z * z * z) OVER () AS p3, y - avg(y) OVER () AS y FROM (SELECT (qty - 25) / 25 AS z, price AS y FROM {SQL_LINES}))"]
    ctes.append("q1 AS (SELECT *, p2 - e1 * (sum(p2 * e1) OVER () / sum(e1 * e1) OVER ()) AS e2 FROM q0)")
    ctes.append("q2 AS (SELECT *, p3 - e1 * (sum(p3 * e1) OVER () / sum(e1 * e1) OVER ()) - e2 * (sum(p3 * e2) OVER () / sum(e2 * e2) OVER ()) AS e3 FROM q1)")
    explained = " + ".join(f"pow(sum(e{k} * y), 2) / sum(e{k} * e{k})" for k in range(1, degree + 1))
    return f"WITH {', '.join(ctes)} SELECT CAST({degree} AS BIGINT) AS degree, {sql_round(f'({explained}) / sum(y * y)', 9)} AS r2 FROM q2"


@query("r7_polynomial_degrees", " UNION ALL ".join(f"({_sql_polynomial(k)})" for k in (1, 2, 3)))
def r7(spark, d):
    """Fit quality of degrees 1 to 3, on the centred feature."""
    rows = lines(spark, d).select(((F.col("qty") - 25) / 25).alias("z"), "price")
    terms = encode.polynomial_terms(["z"], 3)
    names = list(terms)
    cubic = linear.gram(rows.select("price", *[e.alias(n) for n, e in terms.items()]), names, "price")
    out = []
    for degree in (1, 2, 3):
        keep = [0, *range(1, degree + 1), len(names) + 1]
        part = linear.Gram(cubic.sums[keep][:, keep], cubic.shift[[*range(degree), len(names)]])
        out.append((degree, part.scores(part.least_squares())["r2"]))
    return spark.createDataFrame(out, "degree bigint, r2 double").select("degree", r("r2", 9).alias("r2"))


# ---- model selection ----------------------------------------------------------------

_FOLDS = f"""(SELECT *, CAST((row_number() OVER (PARTITION BY flag ORDER BY {sql_hash(7, 'id')}) - 1) % 10 AS BIGINT) AS fold,
 qty / 10 AS x1, disc * 10 AS x2, price / 1000 AS y FROM {SQL_LINES})"""


def folded(spark, d):
    rows = lines(spark, d).select(
        "id", "flag", (F.col("qty") / 10).alias("x1"), (F.col("disc") * 10).alias("x2"), (F.col("price") / 1000).alias("y")
    )
    return sampling.stratified_folds(rows, "id", "flag", 10, seed=7)


def _sql_fold_fits(source: str, groups: str, train: str, l2: str = "0") -> str:
    """Two-feature ridge per group of ``groups`` on its training rows, with scores on both sides.

    ``groups`` is a table of group columns, ``train`` the condition that puts row r into group g's training set.
    """
    return f"""(WITH r AS MATERIALIZED {source}, g AS {groups},
    s AS (SELECT g.*, avg(x1) m1, avg(x2) m2, avg(y) my, var_pop(x1) a, var_pop(x2) c, covar_pop(x1, x2) b, covar_pop(x1, y) u, covar_pop(x2, y) v, count(*) n
      FROM g JOIN r ON {train} GROUP BY ALL),
    w AS (SELECT *, ((c + {l2}) * u - b * v) / ((a + {l2}) * (c + {l2}) - b * b) AS w1, ((a + {l2}) * v - b * u) / ((a + {l2}) * (c + {l2}) - b * b) AS w2 FROM s),
    f AS (SELECT *, my - m1 * w1 - m2 * w2 AS b0 FROM w) SELECT f.*, r.fold AS row_fold, r.* EXCLUDE (fold, id, flag, qty, price, disc, tax, num, status),
    pow(r.y - (b0 + w1 * r.x1 + w2 * r.x2), 2) AS se, {train.replace('g.', 'f.')} AS in_train FROM f, r)"""


_CV = _sql_fold_fits(_FOLDS, "(SELECT unnest(range(10)) AS fold)", "r.fold <> g.fold")


@query(
    "w3_cross_validation",
    f"""WITH p AS {_CV}, m AS (SELECT fold, avg(y) AS mean FROM p WHERE NOT in_train GROUP BY 1)
    SELECT p.fold, {sql_round('avg(se)')} AS mse, {sql_round('1 - sum(se) / sum(pow(y - mean, 2))', 9)} AS r2 FROM p JOIN m USING (fold) WHERE NOT in_train GROUP BY 1""",
)
def w3(spark, d):
    """Ten-fold scores of least squares from one pass."""
    parts = linear.grams(folded(spark, d), ["x1", "x2"], "y", ["fold"])
    rows = select.gram_cv(parts, lambda g: g.least_squares())
    frame = spark.createDataFrame(rows, "fold bigint, train_mse double, train_r2 double, mse double, r2 double")
    return frame.select("fold", r("mse").alias("mse"), r("r2", 9).alias("r2"))


_SIZES = [k / 10 for k in range(1, 11)]
_CURVE = _sql_fold_fits(
    f"(SELECT *, {sql_uniform(11, 'id')} AS uu FROM {_FOLDS})",
    "(SELECT unnest(range(10)) AS fold, s AS size FROM (SELECT unnest(range(1, 11)) / 10.0 AS s))",
    "r.fold <> g.fold AND r.uu < g.size",
)


@query(
    "w5_learning_curve",
    f"""WITH p AS {_CURVE} SELECT CAST(size AS DOUBLE) AS size, fold, {sql_round('avg(se) FILTER (WHERE in_train)')} AS train_mse,
    {sql_round('avg(se) FILTER (WHERE row_fold = fold)')} AS valid_mse FROM p GROUP BY 1, 2""",
)
def w5(spark, d):
    """Training and validation error at ten sizes and ten folds from one pass."""
    rows = select.gram_learning_curve(folded(spark, d), "id", ["x1", "x2"], "y", "fold", _SIZES, lambda g: g.least_squares(), seed=11)
    frame = spark.createDataFrame(rows, "size double, fold bigint, train_mse double, valid_mse double")
    return frame.select("size", "fold", r("train_mse").alias("train_mse"), r("valid_mse").alias("valid_mse"))


_PENALTIES = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]
_RIDGE = _sql_fold_fits(
    _FOLDS,
    "(SELECT unnest(range(10)) AS fold, l AS penalty FROM (SELECT unnest([0.001, 0.01, 0.1, 1.0, 10.0, 100.0])::DOUBLE AS l))",
    "r.fold <> g.fold",
    "penalty / n",
)


@query(
    "w6_validation_curve",
    f"""WITH p AS {_RIDGE} SELECT penalty, fold, {sql_round('avg(se) FILTER (WHERE in_train)')} AS train_mse,
    {sql_round('avg(se) FILTER (WHERE NOT in_train)')} AS valid_mse FROM p GROUP BY 1, 2""",
)
def w6(spark, d):
    """Ridge penalties against training and validation error, all folds, one pass."""
    parts = linear.grams(folded(spark, d), ["x1", "x2"], "y", ["fold"])
    rows = select.gram_validation_curve(parts, _PENALTIES, lambda g, p: g.least_squares(l2=p))
    frame = spark.createDataFrame(rows, "penalty double, fold bigint, train_mse double, valid_mse double")
    return frame.select("penalty", "fold", r("train_mse").alias("train_mse"), r("valid_mse").alias("valid_mse"))


# ---- logistic regression by descent ---------------------------------------------------

_LOGIT = f"(SELECT (qty - 25) / 15 AS x1, (disc - 0.05) / 0.03 AS x2, CAST(flag = 'R' AS DOUBLE) AS y FROM {SQL_LINES})"


def _sql_logistic(eta: float, steps: int) -> str:
    parts = [f"d AS MATERIALIZED (SELECT x1, x2, y, count(*) AS c FROM {_LOGIT} GROUP BY ALL)", "s0 AS (SELECT 0.0::DOUBLE AS b, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, NULL::DOUBLE AS loss)"]
    for k in range(1, steps + 1):
        parts.append(
            f"""s{k} AS (SELECT any_value(b) - {eta} * sum(c * (p - y)) / sum(c) AS b, any_value(w1) - {eta} * sum(c * (p - y) * x1) / sum(c) AS w1,
            any_value(w2) - {eta} * sum(c * (p - y) * x2) / sum(c) AS w2, -sum(c * CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) / sum(c) AS loss
            FROM (SELECT *, 1 / (1 + exp(-(b + w1 * x1 + w2 * x2))) AS p FROM d, s{k - 1}))"""
        )
    rows = " UNION ALL ".join(
        f"SELECT CAST({k} AS BIGINT) AS epoch, {sql_round('loss', 9)} AS loss, {sql_round('b', 9)} AS b, {sql_round('w1', 9)} AS w1, {sql_round('w2', 9)} AS w2 FROM s{k}"
        for k in (steps,)
    )
    return f"WITH {', '.join(parts)} {rows}"


@query("c5_logistic_descent", _sql_logistic(0.5, 8))
def c5_descent(spark, d):
    """Loss and weights after eight epochs of full-batch descent on the log-loss."""
    rows = lines(spark, d).select(
        ((F.col("qty") - 25) / 15).alias("x1"),
        ((F.col("disc") - 0.05) / 0.03).alias("x2"),
        (F.col("flag") == "R").cast("double").alias("y"),
    )
    fit = linear.logistic_descent(rows, ["x1", "x2"], "y", eta=0.5, num_iter=8)
    out = [(8, float(fit.losses[-1]), float(fit.b), float(fit.w[0]), float(fit.w[1]))]
    frame = spark.createDataFrame(out, "epoch bigint, loss double, b double, w1 double, w2 double")
    return frame.select("epoch", *[r(c, 9).alias(c) for c in ("loss", "b", "w1", "w2")])
