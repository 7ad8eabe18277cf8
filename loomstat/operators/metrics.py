"""How good predictions are: classification, ranking and regression metrics.

Rows are reduced to counts (per class pair, per distinct score) by map-side
aggregation first; everything else works on those counts.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstat.operators.ordering import previous_values, running_totals


def accuracy(label: str, prediction: str) -> Column:
    return F.avg((F.col(label) == F.col(prediction)).cast("double"))


def misclassified(label: str, prediction: str) -> Column:
    return F.count_if(F.col(label) != F.col(prediction))


def confusion_counts(df: DataFrame, label: str, prediction: str, by=()) -> DataFrame:
    """(label, prediction, n) on the full grid of the classes seen in either."""
    by = list(by)
    counts = df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    classes = counts.groupBy(*by).agg(
        F.array_distinct(F.concat(F.collect_set("label"), F.collect_set("prediction"))).alias("_classes")
    )
    rows = classes.select(*by, "_classes", F.explode("_classes").alias("label"))
    grid = rows.select(*by, "label", F.explode("_classes").alias("prediction"))
    return grid.join(counts, [*by, "label", "prediction"], "left").na.fill(0, ["n"])


def confusion_table(df: DataFrame, label: str, prediction: str, classes: list) -> DataFrame:
    """One row per true class, one column ``pred_<class>`` per predicted class."""
    counts = [F.count_if(F.col(prediction) == c).alias(f"pred_{c}") for c in classes]
    return df.groupBy(F.col(label).alias("label")).agg(*counts)


def binary_scores(df: DataFrame, label: str, prediction: str, positive=1, by=()) -> DataFrame:
    """Precision, recall, F1 and Matthews correlation; 0 where a margin is empty."""
    t, p = F.col(label) == positive, F.col(prediction) == positive
    counts = df.groupBy(*by).agg(
        F.count_if(t & p).cast("double").alias("tp"),
        F.count_if(~t & p).cast("double").alias("fp"),
        F.count_if(t & ~p).cast("double").alias("fn"),
        F.count_if(~t & ~p).cast("double").alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    margins = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    return counts.select(
        *by,
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(tp * tn - fp * fn, F.sqrt(margins)).alias("mcc"),
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _score_totals(df: DataFrame, label: str, score: str, by) -> DataFrame:
    """Positives and negatives per distinct score with their running totals, best score first."""
    grouped = df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
    )
    sums = {"tp": F.col("_pos"), "fp": F.col("_neg")}
    return running_totals(grouped, [F.col("score").desc()], sums, by, with_total=True)


def roc_curve(df: DataFrame, label: str, score: str, by=()) -> DataFrame:
    """(fpr, tpr, threshold) for every distinct score, after the origin (threshold NULL).

    A rate is NULL in a group without rows of its class.
    """
    by = list(by)
    return _points(_score_totals(df, label, score, by), by)


def _points(totals: DataFrame, by: list[str]) -> DataFrame:
    points = totals.select(
        *by,
        (F.col("fp") / F.nullif("fp_total", F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif("tp_total", F.lit(0))).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    zero = F.lit(0.0)
    groups = points.select(*by).distinct() if by else totals.sparkSession.range(1)
    return points.unionByName(groups.select(*by, zero.alias("fpr"), zero.alias("tpr"), F.lit(None).cast("double").alias("threshold")))


def roc_auc(df: DataFrame, label: str, score: str, by=()) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counting half; NULL for one class only."""
    by = list(by)
    return _areas(_score_totals(df, label, score, by), by)


def _areas(totals: DataFrame, by: list[str]) -> DataFrame:
    won = F.col("_neg") * (F.col("tp") - F.col("_pos") / 2)
    pairs = F.nullif(F.max("tp_total") * F.max("fp_total"), F.lit(0))
    return totals.groupBy(*by).agg((F.sum(won) / pairs).alias("auc"))


def curve_area(df: DataFrame, x: str, y: str, by=()) -> DataFrame:
    """Trapezoid area under the points in order of (x, y)."""
    stepped = previous_values(df.select(*by, x, y).distinct(), [x, y], [x, y], by)
    trapezoid = (F.col(x) - F.col(f"prev_{x}")) * (F.col(y) + F.col(f"prev_{y}")) / 2
    return stepped.groupBy(*by).agg(F.sum(F.coalesce(trapezoid, F.lit(0.0))).alias("auc"))


def multiclass_auc(df: DataFrame, label: str, probabilities: str, classes: int) -> DataFrame:
    """One-against-one average of the AUC over all ordered class pairs.

    ``probabilities`` is an array by class 0..classes-1.  A row takes part in the
    pairs of its own class only: as positive against each other class, and as
    negative for each other class's own score.
    """
    everyone = F.array(*[F.lit(c) for c in range(classes)])
    others = F.filter(everyone, lambda c: c != F.col(label))
    own = F.col(label).cast("int")
    p = F.col(probabilities)
    as_positive = F.transform(others, lambda c: F.struct(own.alias("i"), c.alias("j"), F.lit(1).alias("y"), F.element_at(p, own + 1).alias("s")))
    as_negative = F.transform(others, lambda c: F.struct(c.alias("i"), own.alias("j"), F.lit(0).alias("y"), F.element_at(p, c + 1).alias("s")))
    pairs = df.select(F.inline(F.concat(as_positive, as_negative)))
    return roc_auc(pairs, "y", "s", by=["i", "j"]).agg(F.avg("auc").alias("auc"))


def interpolated(curve: DataFrame, x: str, y: str, grid: list[float], by: list[str]) -> DataFrame:
    """The curve's value at each grid point, by straight lines between its points.

    Left of the first point its value holds, right of the last point the last.
    A curve's points are first reduced to two per grid cell, so a curve with very
    many points is never gathered in one task.
    """
    import math

    grid = sorted(grid)
    # Cell g takes the points with grid[g-1] < x <= grid[g]; negation makes that a left-closed bucket.
    splits = [-math.inf] + [-g for g in reversed(grid)] + [math.inf]
    negated = curve.select(*by, F.col(x).alias("px"), F.col(y).alias("py"), (-F.col(x)).alias("_neg"))
    cells = Bucketizer(splits=splits, inputCol="_neg", outputCol="_b").transform(negated)
    cells = cells.withColumn("cell", (F.lit(len(grid)) - F.col("_b")).cast("int"))
    grid_array = F.array(*[F.lit(float(g)) for g in grid])
    at = F.when(F.col("cell") < len(grid), F.element_at(grid_array, F.col("cell") + 1))
    point = F.struct("px", "py")
    reduced = cells.groupBy(*by, "cell").agg(
        F.min(point).alias("first"),
        F.max(point).alias("last"),
        F.max(F.when(F.col("px") < at, point)).alias("below"),
        F.min(F.when(F.col("px") == at, point)).alias("exact"),
    )
    groups = reduced.select(*by).distinct()
    every_cell = groups.select(*by, F.posexplode(F.concat(grid_array, F.array(F.lit(None).cast("double")))).alias("cell", "gx"))
    joined = every_cell.join(reduced, [*by, "cell"], "left")
    before = Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy("cell").rowsBetween(1, Window.unboundedFollowing)
    found = joined.select(
        *by,
        F.col("cell").cast("bigint").alias("grid_id"),
        "gx",
        F.coalesce(F.col("below"), F.last("last", ignorenulls=True).over(before)).alias("lo"),
        F.coalesce(F.col("exact"), F.first("first", ignorenulls=True).over(after)).alias("hi"),
    ).where("gx is not null")
    slope = (F.col("hi.py") - F.col("lo.py")) / (F.col("hi.px") - F.col("lo.px"))
    value = (
        F.when(F.col("hi").isNull(), F.col("lo.py"))
        .when(F.col("lo").isNull(), F.col("hi.py"))
        .otherwise(F.col("lo.py") + (F.col("gx") - F.col("lo.px")) * slope)
    )
    return found.select(*by, "grid_id", F.col("gx").alias(x), value.alias(y))


def mean_roc(df: DataFrame, label: str, score: str, fold: str, points: int = 100) -> DataFrame:
    """Average of the folds' ROC curves on an even grid that starts at 0; folds of one class take no part."""
    return _mean_curve(roc_curve(df, label, score, [fold]), fold, points)


def _mean_curve(curves: DataFrame, fold: str, points: int) -> DataFrame:
    grid = [g / (points - 1) for g in range(points)]
    both = curves.groupBy(fold).agg(F.count_if(F.col("fpr").isNull() | F.col("tpr").isNull()).alias("_gaps")).where("_gaps = 0").select(fold)
    curves = interpolated(curves.join(both, fold), "fpr", "tpr", grid, [fold])
    tpr = F.when(F.col("grid_id") == 0, F.lit(0.0)).otherwise(F.col("tpr"))
    return curves.withColumn("tpr", tpr).groupBy("grid_id", "fpr").agg(F.avg("tpr").alias("tpr"))


def mean_roc_area(df: DataFrame, label: str, score: str, fold: str, points: int = 100) -> DataFrame:
    """(mean_auc, std_auc): area under the mean curve, and the spread of the folds' own areas."""
    totals = _score_totals(df, label, score, [fold])
    spread = _areas(totals, [fold]).agg(F.stddev_samp("auc")).scalar()
    mean = _mean_curve(_points(totals, [fold]), fold, points)
    step = Window.orderBy("grid_id")  # ``points`` rows
    trapezoid = (F.col("fpr") - F.lag("fpr").over(step)) * (F.col("tpr") + F.lag("tpr").over(step)) / 2
    return mean.select(trapezoid.alias("a")).agg(F.sum("a").alias("mean_auc")).withColumn("std_auc", spread)


def regression_scores(df: DataFrame, label: str, prediction: str, by=(), n_features: int | None = None) -> DataFrame:
    """n, mse, mae, r2 (and adj_r2) in one pass over the rows without a NULL.

    For a constant label r2 is 1 without errors, else 0.
    """
    residual = F.col(label) - F.col(prediction)
    sums = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(residual * residual).alias("mse"),
        F.avg(F.abs(residual)).alias("mae"),
        F.var_pop(label).alias("_spread"),
    )
    constant = F.when(F.col("mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    scored = sums.withColumn("r2", F.when(F.col("_spread") == 0, constant).otherwise(1 - F.col("mse") / F.col("_spread"))).drop("_spread")
    if n_features is None:
        return scored
    n = F.col("n")
    return scored.withColumn("adj_r2", 1 - (1 - F.col("r2")) * (n - 1) / F.nullif(n - n_features - 1, F.lit(0)))


def residual(label: str, prediction: str) -> Column:
    return F.col(prediction) - F.col(label)
