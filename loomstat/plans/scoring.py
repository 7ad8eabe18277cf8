"""Metric queries: confusion counts, ranking curves, regression scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.operators import metrics, sampling
from loomstat.plans.registry import SQL_LINES, big, lines, query, r, sql_hash, sql_round
from loomstat.sources.tables import table

_BANDS = f"(SELECT num AS label, CAST(floor(qty / 50 * 6) AS BIGINT) + 1 AS prediction FROM {SQL_LINES})"


def bands(spark, d):
    """Seven classes (line number) and a prediction made from the quantity."""
    return lines(spark, d).select(F.col("num").alias("label"), (big(F.floor(F.col("qty") / 50 * 6)) + 1).alias("prediction"))


_SCORED = f"(SELECT id, CAST(flag = 'R' AS BIGINT) AS label, price AS score, CAST(price > 52000 AS BIGINT) AS prediction FROM {SQL_LINES})"


def scored(spark, d):
    """A binary label, a score and a hard prediction per line."""
    return lines(spark, d).select(
        "id",
        big(F.col("flag") == "R").alias("label"),
        F.col("price").alias("score"),
        big(F.col("price") > 52000).alias("prediction"),
    )


@query("v1_accuracy", f"SELECT {sql_round('avg(CAST(label = prediction AS INT))', 9)} AS accuracy FROM {_BANDS}")
def v1(spark, d):
    return bands(spark, d).agg(r(metrics.accuracy("label", "prediction"), 9).alias("accuracy"))


@query("v2_misclassified", f"SELECT CAST(count_if(label <> prediction) AS BIGINT) AS wrong FROM {_BANDS}")
def v2(spark, d):
    return bands(spark, d).agg(metrics.misclassified("label", "prediction").alias("wrong"))


@query(
    "v3_confusion_matrix",
    f"""WITH t AS {_BANDS}, c AS (SELECT label AS c FROM t UNION SELECT prediction FROM t)
    SELECT a.c AS label, b.c AS prediction, (SELECT count(*) FROM t WHERE t.label = a.c AND t.prediction = b.c) AS n FROM c a, c b""",
)
def v3(spark, d):
    return metrics.confusion_counts(bands(spark, d), "label", "prediction")


@query(
    "v4_confusion_table",
    f"SELECT label, {', '.join(f'CAST(count_if(prediction = {k}) AS BIGINT) AS pred_{k}' for k in range(1, 8))} FROM {_BANDS} GROUP BY 1",
)
def v4(spark, d):
    return metrics.confusion_table(bands(spark, d), "label", "prediction", list(range(1, 8)))


_COUNTS = f"""(SELECT CAST(count_if(label = 1 AND prediction = 1) AS DOUBLE) tp, CAST(count_if(label = 0 AND prediction = 1) AS DOUBLE) fp,
 CAST(count_if(label = 1 AND prediction = 0) AS DOUBLE) fn, CAST(count_if(label = 0 AND prediction = 0) AS DOUBLE) tn FROM {_SCORED})"""

for _name, _col, _expr in (
    ("v5_precision", "precision", "tp/(tp+fp)"),
    ("v6_recall", "recall", "tp/(tp+fn)"),
    ("v7_f1", "f1", "2*tp/(2*tp+fp+fn)"),
    ("v8_matthews", "mcc", "(tp*tn-fp*fn)/sqrt((tp+fp)*(tp+fn)*(tn+fp)*(tn+fn))"),
):

    @query(_name, f"SELECT {sql_round(_expr, 9)} AS {_col} FROM {_COUNTS}")
    def _binary(spark, d, col=_col):
        return metrics.binary_scores(scored(spark, d), "label", "prediction").select(r(col, 9).alias(col))


def _sql_roc(source: str, by: str = "") -> str:
    """Points of the curve per distinct score, and the origin."""
    lead, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    origin = f"SELECT DISTINCT {lead}0.0, 0.0, NULL FROM g" if by else "SELECT 0.0, 0.0, NULL"
    return f"""(WITH g AS (SELECT {lead}score, count_if(label = 1) AS p, count_if(label <> 1) AS n FROM {source} GROUP BY {lead}score)
    SELECT {lead}CAST(sum(n) OVER ({part}ORDER BY score DESC) / sum(n) OVER ({part}) AS DOUBLE) AS fpr,
    CAST(sum(p) OVER ({part}ORDER BY score DESC) / sum(p) OVER ({part}) AS DOUBLE) AS tpr, score AS threshold FROM g
    UNION ALL {origin})"""


def _sql_auc(source: str, by: str = "") -> str:
    lead, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    group = f"GROUP BY {by}" if by else ""
    return f"""(SELECT {lead}sum((fpr - px) * (tpr + py) / 2) AS auc FROM (SELECT *, lag(fpr) OVER ({part}ORDER BY fpr, tpr) AS px,
    lag(tpr) OVER ({part}ORDER BY fpr, tpr) AS py FROM {_sql_roc(source, by)}) {group})"""


@query("v9_roc_curve", f"SELECT {sql_round('fpr', 9)} AS fpr, {sql_round('tpr', 9)} AS tpr, threshold FROM {_sql_roc(_SCORED)}")
def v9(spark, d):
    points = metrics.roc_curve(scored(spark, d), "label", "score")
    return points.select(r("fpr", 9).alias("fpr"), r("tpr", 9).alias("tpr"), "threshold")


@query("v10_curve_area", f"SELECT {sql_round('auc', 9)} AS auc FROM {_sql_auc(_SCORED)}")
def v10(spark, d):
    curve = metrics.roc_curve(scored(spark, d), "label", "score")
    return metrics.curve_area(curve, "fpr", "tpr").select(r("auc", 9).alias("auc"))


@query(
    "v11_roc_auc",
    f"""WITH t AS (SELECT label, score, rank() OVER (ORDER BY score) AS lo, count(*) OVER (PARTITION BY score) AS c FROM {_SCORED}),
    s AS (SELECT sum(CASE WHEN label = 1 THEN lo + (c - 1) / 2 END) AS ranks, count_if(label = 1) AS p, count_if(label = 0) AS n FROM t)
    SELECT {sql_round('(ranks - p * (p + 1) / 2) / (p * n)', 9)} AS auc FROM s""",
)
def v11(spark, d):
    return metrics.roc_auc(scored(spark, d), "label", "score").select(r("auc", 9).alias("auc"))


_RAW = ["qty / 50", "disc * 10", "tax * 12.5"]
_MATRIX = f"""(SELECT CASE flag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label, r0/(r0+r1+r2) AS p0, r1/(r0+r1+r2) AS p1, r2/(r0+r1+r2) AS p2
 FROM (SELECT flag, {', '.join(f'{e} AS r{k}' for k, e in enumerate(_RAW))} FROM {SQL_LINES}))"""


def _sql_ovo() -> str:
    pairs = [
        f"SELECT {i * 3 + j} AS pair, CAST(label = {i} AS INT) AS y, p{i} AS s FROM m WHERE label IN ({i}, {j})"
        for i in range(3)
        for j in range(3)
        if i != j
    ]
    return f"""WITH m AS {_MATRIX}, x AS ({' UNION ALL '.join(pairs)}),
    t AS (SELECT pair, y, rank() OVER (PARTITION BY pair ORDER BY s) AS lo, count(*) OVER (PARTITION BY pair, s) AS c FROM x),
    a AS (SELECT pair, sum(CASE WHEN y = 1 THEN lo + (c - 1) / 2 END) AS ranks, count_if(y = 1) AS p, count_if(y = 0) AS n FROM t GROUP BY 1)
    SELECT {sql_round('avg((ranks - p * (p + 1) / 2) / (p * n))', 9)} AS auc FROM a"""


@query("v12_multiclass_auc", _sql_ovo())
def v12(spark, d):
    raw = [F.col("qty") / 50, F.col("disc") * 10, F.col("tax") * 12.5]
    total = raw[0] + raw[1] + raw[2]
    label = F.when(F.col("flag") == "A", 0).when(F.col("flag") == "N", 1).otherwise(2)
    rows = lines(spark, d).select(label.alias("label"), F.array(*[x / total for x in raw]).alias("p"))
    return metrics.multiclass_auc(rows, "label", "p", 3).select(r("auc", 9).alias("auc"))


_FOLDED = f"""(SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY {sql_hash(42, 'id')}) - 1) % 3 AS BIGINT) AS fold FROM {_SCORED})"""


def folded(spark, d):
    """The scored lines dealt to three shuffled folds."""
    rows = scored(spark, d).select("id", "label", "score")
    return sampling.stratified_folds(rows, "id", "label", 3, seed=42).withColumn("fold", big("fold"))


_INTERPOLATED = f"""(WITH roc AS {_sql_roc(_FOLDED, 'fold')}, grid AS (SELECT unnest(range(100)) AS grid_id),
 near AS (SELECT fold, grid_id, grid_id / 99.0 AS g, max(fpr) FILTER (WHERE fpr < grid_id / 99.0) AS x0, max(tpr) FILTER (WHERE fpr < grid_id / 99.0) AS y0,
  min(fpr) FILTER (WHERE fpr >= grid_id / 99.0) AS x1, min(tpr) FILTER (WHERE fpr >= grid_id / 99.0) AS y1 FROM roc, grid GROUP BY 1, 2)
 SELECT fold, grid_id, CAST(g AS DOUBLE) AS fpr, CASE WHEN x0 IS NULL THEN y1 WHEN x1 IS NULL THEN y0 ELSE y0 + (g - x0) * (y1 - y0) / (x1 - x0) END AS tpr FROM near)"""


@query("j5_interpolated_curve", f"SELECT fold, grid_id, {sql_round('fpr', 9)} AS fpr, {sql_round('tpr', 9)} AS tpr FROM {_INTERPOLATED}")
def j5(spark, d):
    """Each fold's curve read off at 100 even points."""
    curves = metrics.roc_curve(folded(spark, d), "label", "score", ["fold"])
    at = metrics.interpolated(curves, "fpr", "tpr", [g / 99 for g in range(100)], ["fold"])
    return at.select("fold", "grid_id", r("fpr", 9).alias("fpr"), r("tpr", 9).alias("tpr"))


_MEAN_ROC = f"(SELECT grid_id, fpr, avg(CASE WHEN grid_id = 0 THEN 0 ELSE tpr END) AS tpr FROM {_INTERPOLATED} GROUP BY 1, 2)"


@query("a11_mean_curve", f"SELECT grid_id, {sql_round('fpr', 9)} AS fpr, {sql_round('tpr', 9)} AS tpr FROM {_MEAN_ROC}")
def a11(spark, d):
    mean = metrics.mean_roc(folded(spark, d), "label", "score", "fold")
    return mean.select("grid_id", r("fpr", 9).alias("fpr"), r("tpr", 9).alias("tpr"))


@query(
    "v13_mean_roc",
    f"""WITH m AS {_MEAN_ROC}, steps AS (SELECT *, lag(fpr) OVER (ORDER BY grid_id) px, lag(tpr) OVER (ORDER BY grid_id) py FROM m)
    SELECT {sql_round('sum((fpr - px) * (tpr + py) / 2)', 9)} AS mean_auc, (SELECT {sql_round('stddev_samp(auc)', 9)} FROM {_sql_auc(_FOLDED, 'fold')}) AS std_auc FROM steps""",
)
def v13(spark, d):
    """Area under the mean curve, and the spread of the folds' own areas."""
    area = metrics.mean_roc_area(folded(spark, d), "label", "score", "fold")
    return area.select(r("mean_auc", 9).alias("mean_auc"), r("std_auc", 9).alias("std_auc"))


_PREDICTED = f"(SELECT id, flag, price AS label, 1000 * qty + 2000 * num AS prediction FROM {SQL_LINES})"


def predicted(spark, d):
    return lines(spark, d).select("id", "flag", F.col("price").alias("label"), (1000 * F.col("qty") + 2000 * F.col("num")).alias("prediction"))


_SQL_R2 = "1 - sum(pow(label - prediction, 2)) / sum(pow(label - mean, 2))"
_WITH_MEAN = f"(SELECT *, avg(label) OVER () AS mean FROM {_PREDICTED})"

for _name, _col, _expr in (
    ("v14_mean_squared_error", "mse", sql_round("avg(pow(label - prediction, 2))", 3)),
    ("v15_mean_absolute_error", "mae", sql_round("avg(abs(label - prediction))")),
    ("v16_r2", "r2", sql_round(_SQL_R2, 9)),
    ("v17_adjusted_r2", "adj_r2", sql_round(f"1 - (1 - ({_SQL_R2})) * (count(*) - 1) / (count(*) - 2 - 1)", 9)),
):

    @query(_name, f"SELECT {_expr} AS {_col} FROM {_WITH_MEAN}")
    def _regression(spark, d, col=_col):
        scores = metrics.regression_scores(predicted(spark, d), "label", "prediction", n_features=2)
        return scores.select(r(col, {"mse": 3, "mae": 6}.get(col, 9)).alias(col))


@query("r10_residual", f"SELECT id, {sql_round('prediction - label', 4)} AS residual FROM {_PREDICTED}")
def r10(spark, d):
    return predicted(spark, d).select("id", r(metrics.residual("label", "prediction"), 4).alias("residual"))


@query(
    "a10_mean_std_over_folds",
    f"SELECT {sql_round('avg(auc)', 9)} AS mean, {sql_round('stddev_samp(auc)', 9)} AS std, count(*) AS folds FROM {_sql_auc(_FOLDED, 'fold')}",
)
def a10(spark, d):
    aucs = metrics.roc_auc(folded(spark, d), "label", "score", ["fold"])
    return aucs.agg(r(F.avg("auc"), 9).alias("mean"), r(F.stddev_samp("auc"), 9).alias("std"), F.count(F.lit(1)).alias("folds"))
