"""Clusters: k-means, how well rows sit in them, and merging small ones."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans, KMeans, KMeansModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions.maths import dot
from loomstat.operators import linkage
from loomstat.operators.batches import matrix, summed
from loomstat.operators.neighbors import distance_sums


_PACK, _CELL = 1 << 16, 32  # points of a pack and of a cell


@dataclass
class ClusterFit:
    centres: np.ndarray
    sizes: np.ndarray
    inertia: float
    iterations: int


def _draws(base: np.ndarray, seed: int, turn: int, fit: int) -> np.ndarray:
    """Uniform numbers in (0, 1] from row hashes, other ones for each seed, turn and fit."""
    salt = np.uint64((seed * 1_000_003 + turn * 10_007 + fit) * 0x9E3779B97F4A7C15 % 2**64)
    x = base ^ salt
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype("float64") / 2**53 + 2**-54


def _squares(columns: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances of points, given column by column, to a centre."""
    out = np.zeros(columns.shape[1])
    for x, c in zip(columns, centre):
        gap = x - c
        gap *= gap
        out += gap
    return out


def _drawn(rows: DataFrame, chosen: list[list[np.ndarray]], spread_out: list[bool], full: list[bool], seed: int, turn: int) -> list[np.ndarray | None]:
    """One more centre for each fit that is not ``full``, out of all rows in one pass.

    A row's odds are even, or its squared distance to the fit's nearest centre: the
    smallest of ``-log(u) / odds`` is such a draw, and minima combine task by task.
    A row that is already a centre has no odds.
    """

    def task(batches):
        best = [(np.inf, None)] * len(chosen)
        for batch in batches:
            x, base = matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            columns = np.ascontiguousarray(x.T)
            for i, centres in enumerate(chosen):
                if full[i]:
                    continue
                odds = np.ones(len(x))
                if centres:
                    d2 = reduce(np.minimum, (_squares(columns, c) for c in centres))
                    odds = d2 if spread_out[i] else (d2 > 0).astype("float64")
                with np.errstate(divide="ignore"):
                    score = np.where(odds > 0, -np.log(_draws(base, seed, turn, i)) / odds, np.inf)
                at = int(score.argmin()) if len(score) else 0
                if len(score) and score[at] < best[i][0]:
                    best[i] = (float(score[at]), x[at].tolist())
        kept = [(i, s, v) for i, (s, v) in enumerate(best) if v is not None]
        if kept:
            fits, scores, points = zip(*kept)
            arrays = [pa.array(fits, pa.int32()), pa.array(scores, pa.float64()), pa.array(points, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["fit", "score", "v"])

    found = rows.mapInArrow(task, "fit int, score double, v array<double>").groupBy("fit").agg(F.min_by("v", "score").alias("v")).collect()
    out: list[np.ndarray | None] = [None] * len(chosen)
    for row in found:
        out[row["fit"]] = np.array(row["v"])
    return out


def starting_points(rows: DataFrame, settings: list[tuple[int, str]], seed: int) -> list[np.ndarray]:
    """Start centres for each (k, init), drawn from all ``rows`` (vec, hash): one pass per centre, for all fits."""
    chosen: list[list[np.ndarray]] = [[] for _ in settings]
    for turn in range(max(k for k, _ in settings)):
        full = [len(held) >= k for (k, _), held in zip(settings, chosen)]
        more = _drawn(rows, chosen, [init == "k-means++" for _, init in settings], full, seed, turn)
        for (k, _), held, v in zip(settings, chosen, more):
            if len(held) < k and v is not None:
                held.append(v)
    # with fewer different rows than centres some centres stand twice
    return [np.array([held[i % len(held)] for i in range(k)]) for (k, _), held in zip(settings, chosen) if held]


def stacked_lloyd(df: DataFrame, vec: str, starts: list[np.ndarray], max_iter: int, settle: float) -> list[ClusterFit]:
    """Lloyd's rounds for many starts at once: one pass over the rows moves them all.

    A task returns one row of sums for all starts and clusters.  A start is done
    when its centres move by less than ``settle`` (sum of squares) in a round.  Rows are
    packed into cells of near ones first, see ``_packed``.
    """
    width = starts[0].shape[1]
    fits = [ClusterFit(np.array(s, dtype="float64"), np.zeros(len(s)), float("inf"), 0) for s in starts]
    active = list(range(len(fits)))
    rows = _packed(df.select(vec).coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)).persist()
    try:
        while active:
            parts = _one_pass(rows, [fits[i].centres for i in active], width)
            moving = []
            for i, part in zip(active, parts):
                fit, held = fits[i], part[:, :1] > 0
                moved = np.where(held, part[:, 2:] / np.maximum(part[:, :1], 1), fit.centres)
                fit.sizes, fit.inertia, fit.iterations = part[:, 0], float(part[:, 1].sum()), fit.iterations + 1
                if ((moved - fit.centres) ** 2).sum() > settle and fit.iterations <= max_iter:
                    fit.centres = moved
                    moving.append(i)
            active = moving
    finally:
        rows.unpersist()
    return fits


def _packed(rows: DataFrame) -> DataFrame:
    """(points, sizes): some ``_PACK`` points each, one after another by cells of near points; column by column.

    A cell comes from halving the points along their widest column.  Most cells lie wholly
    nearest to one centre, whatever the centres are; such a cell counts by its mean.
    """

    def task(batches):
        held, n = [], 0
        for batch in batches:
            held.append(matrix(batch.column(0)))
            n += len(held[-1])
            if n >= _PACK:
                yield _pack(np.concatenate(held))
                held, n = [], 0
        if n:
            yield _pack(np.concatenate(held))

    return rows.mapInArrow(task, "points array<double>, sizes array<int>")


def _pack(x: np.ndarray) -> pa.RecordBatch:
    cells, sizes = [np.arange(len(x))], []
    out = []
    while cells:
        at = cells.pop()
        points = x[at]
        spread = points.max(axis=0) - points.min(axis=0)
        if len(at) <= _CELL or not spread.max() > 0:
            out.append(at)
            sizes.append(len(at))
            continue
        order = np.argpartition(points[:, int(spread.argmax())], len(at) // 2)
        cells += [at[order[: len(at) // 2]], at[order[len(at) // 2 :]]]
    points = np.ascontiguousarray(x[np.concatenate(out)].T).ravel()
    return pa.RecordBatch.from_arrays([pa.array([points], pa.list_(pa.float64())), pa.array([sizes], pa.list_(pa.int32()))], ["points", "sizes"])


class _Cells:
    """The points of a pack, and mean, spread and box of each of its cells."""

    def __init__(self, columns: np.ndarray, sizes: np.ndarray):
        self.columns, self.sizes = columns, sizes
        self.first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.means = np.add.reduceat(columns, self.first, axis=1) / sizes
        self.low, self.high = np.minimum.reduceat(columns, self.first, axis=1), np.maximum.reduceat(columns, self.first, axis=1)
        self.spread = np.add.reduceat(((columns - np.repeat(self.means, sizes, axis=1)) ** 2).sum(axis=0), self.first)

    def add(self, centres: np.ndarray, part: np.ndarray) -> None:
        """Add (n, cost, sums...) of the points nearest to each centre; the first on ties."""
        k, each = len(centres), np.arange(len(self.sizes))
        d2 = np.stack([_squares(self.means, c) for c in centres])
        near = d2.argmin(axis=0)
        own = centres[near].T
        # the corner of the box that favours another centre most decides whether any point can be nearer to it
        whole = np.ones(len(near), bool)
        for j, c in enumerate(centres):
            lead = np.zeros(len(near))
            for i in range(len(c)):
                corner = np.where(c[i] > own[i], self.high[i], self.low[i])
                lead += (corner - c[i]) ** 2 - (corner - own[i]) ** 2
            whole &= (lead > 1e-9 * (d2[j] + d2[near, each])) | (near == j)
        n = np.where(whole, self.sizes, 0)
        part[:, 0] += np.bincount(near, weights=n, minlength=k)
        part[:, 1] += np.bincount(near, weights=np.where(whole, self.spread + n * d2[near, each], 0.0), minlength=k)
        for i, mean in enumerate(self.means):
            part[:, 2 + i] += np.bincount(near, weights=n * mean, minlength=k)
        if whole.all():
            return
        x = self.columns[:, np.repeat(~whole, self.sizes)]
        d2 = np.stack([_squares(x, c) for c in centres])
        near, low = d2.argmin(axis=0), d2.min(axis=0)
        part[:, 0] += np.bincount(near, minlength=k)
        part[:, 1] += np.bincount(near, weights=low, minlength=k)
        for i, v in enumerate(x):
            part[:, 2 + i] += np.bincount(near, weights=v, minlength=k)


def _one_pass(rows: DataFrame, centres: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Per start a matrix with one row (n, cost, sums...) per cluster."""
    cuts = np.cumsum([0, *(len(c) * (width + 2) for c in centres)])

    def sums(batches):
        acc = np.zeros(cuts[-1])
        for batch in batches:
            for points, sizes in zip(batch.column(0), batch.column(1)):
                x = points.values.to_numpy(zero_copy_only=False).reshape(width, -1)
                cell = _Cells(x, sizes.values.to_numpy(zero_copy_only=False))
                for start, stop, c in zip(cuts[:-1], cuts[1:], centres):
                    cell.add(c, acc[start:stop].reshape(len(c), width + 2))
        return acc

    total = summed(rows, sums, int(cuts[-1]))
    return [total[a:b].reshape(-1, width + 2) for a, b in zip(cuts[:-1], cuts[1:])]


def _fits(df: DataFrame, key: str, vec: str, settings, max_iter: int, tol: float, seed: int) -> list[ClusterFit]:
    """``tol`` is relative to the mean variance of the columns; no rows give no fits."""
    hashed = df.select(F.col(vec).cast("array<double>").alias(vec), F.xxhash64(key).alias("_h")).persist()
    try:
        starts = starting_points(hashed, settings, seed)
        if not starts:
            return []
        width = starts[0].shape[1]
        spread = hashed.agg(*[F.var_pop(F.col(vec)[i]).alias(f"v{i}") for i in range(width)]).first()
        return stacked_lloyd(hashed, vec, starts, max_iter, tol * float(np.mean(list(spread))))
    finally:
        hashed.unpersist()


def kmeans(df: DataFrame, key: str, vec: str, k: int, init: str = "k-means++", n_init: int = 10, max_iter: int = 300, tol: float = 1e-4, seed: int = 0) -> ClusterFit:
    """The fit of lowest inertia out of ``n_init`` starts (``init`` "random" or "k-means++"); no centres without rows."""
    fits = _fits(df, key, vec, [(k, init)] * n_init, max_iter, tol, seed)
    return min(fits, key=lambda f: f.inertia, default=ClusterFit(np.zeros((0, 0)), np.zeros(0), 0.0, 0))


def ml_kmeans(df: DataFrame, k: int, max_iter: int = 50, seed: int = 0, features: str = "features") -> KMeansModel:
    """Spark ML's k-means, for many clusters or wide vectors."""
    return KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features, predictionCol="cluster").fit(df.select(features))


def squared_distance(xs: list[Column], centre) -> Column:
    parts = [(x - F.lit(float(c))) * (x - F.lit(float(c))) for x, c in zip(xs, centre)]
    return reduce(lambda a, b: a + b, parts)


def with_nearest(df: DataFrame, xs: list[str], centres: np.ndarray, out: str = "cluster") -> DataFrame:
    """Add the nearest centre (the first on ties) and the squared distance to it."""
    distances = F.array(*[squared_distance([F.col(x) for x in xs], c) for c in centres])
    seen = df.withColumn("_d", distances).withColumn("d2", F.array_min("_d"))
    return seen.withColumn(out, (F.array_position("_d", F.col("d2")) - 1).cast("bigint")).drop("_d")


def lloyd_steps(df: DataFrame, xs: list[str], centres: np.ndarray, steps: int) -> np.ndarray:
    """Move the centres to the means of their rows, ``steps`` times."""
    centres = np.array(centres, dtype="float64")
    for _ in range(steps):
        means = with_nearest(df, xs, centres).groupBy("cluster").agg(*[F.avg(x).alias(x) for x in xs]).collect()
        for row in means:
            centres[row["cluster"]] = [row[x] for x in xs]
    return centres


def elbow(df: DataFrame, key: str, vec: str, ks, n_init: int = 10, max_iter: int = 300, tol: float = 1e-4, seed: int = 123) -> DataFrame:
    """(k, inertia) for several numbers of clusters; all fits share their passes."""
    settings = [(k, "k-means++") for k in ks for _ in range(n_init)]
    fits = _fits(df, key, vec, settings, max_iter, tol, seed)
    best: dict[int, float] = {}
    for (k, _), fit in zip(settings, fits):
        best[k] = min(best.get(k, fit.inertia), fit.inertia)
    return df.sparkSession.createDataFrame([(int(k), float(v)) for k, v in best.items()], "k bigint, inertia double")


def _from_means(sums: DataFrame, key: str, cluster: str) -> DataFrame:
    """Silhouette values from (key, cluster, other, mean distance, n of the other)."""
    own = F.col("other") == F.col(cluster)
    a = F.max(F.when(own, F.col("total") / F.greatest(F.col("n") - 1, F.lit(1))))
    alone = F.max(F.when(own, F.col("n"))) <= 1
    b = F.min(F.when(~own, F.col("total") / F.col("n")))
    ab = sums.groupBy(key, cluster).agg(a.alias("a"), b.alias("b"), alone.alias("_alone"))
    spread = F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0))  # equal points: 0
    value = F.when(F.col("_alone") | F.col("b").isNull(), F.lit(0.0)).otherwise(spread)
    return ab.select(key, cluster, value.alias("silhouette"))


def silhouette(rows: DataFrame, key: str, vec: str, cluster: str, block: int = 16384) -> DataFrame:
    """(key, cluster, silhouette) with Euclidean distances: exact, and quadratic in the rows."""
    sums = distance_sums(rows, key, vec, cluster, block)
    return _from_means(sums.join(rows.select(key, cluster), key), key, cluster)


def silhouette_squared(rows: DataFrame, key: str, vec: str, cluster: str, width: int) -> DataFrame:
    """As ``silhouette`` with squared distances, in linear time.

    The mean squared distance from a row to a cluster follows from the cluster's
    mean and mean square, so every row looks at the clusters only.
    """
    v = F.col(vec)
    sums = rows.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), F.avg(dot(v, v)).alias("square"), *[F.avg(v[i].cast("double")).alias(f"m{i}") for i in range(width)]
    )
    known = [(r[cluster], r["n"], r["square"], [r[f"m{i}"] for i in range(width)]) for r in sums.collect()]
    entries = [
        F.struct(
            F.lit(c).alias("other"),
            F.lit(n).cast("bigint").alias("n"),
            ((dot(v, v) - 2 * dot(v, F.array(*[F.lit(float(x)) for x in mean])) + F.lit(float(square))) * F.lit(n)).alias("total"),
        )
        for c, n, square, mean in known
    ]
    return _from_means(rows.select(key, cluster, F.inline(F.array(*entries))), key, cluster)


def agglomerate(df: DataFrame, n_clusters: int, micro: int, seed: int = 0, features: str = "features") -> tuple[DataFrame, DataFrame]:
    """Rows with a ``cluster`` label, and the merges (a, b, distance, round) behind it.

    K-means first makes ``micro`` small clusters; their centres are merged by complete
    linkage (see ``linkage``) and each row takes the label of its own.
    """
    model = ml_kmeans(df, micro, max_iter=50, seed=seed, features=features)
    centres = [(i, c.tolist()) for i, c in enumerate(model.clusterCenters())]
    items = df.sparkSession.createDataFrame(centres, "_micro bigint, _centre array<double>")
    merges = linkage.complete_linkage(linkage.pair_distances(items, "_micro", "_centre"))
    labels = linkage.cut(merges, items, "_micro", min(n_clusters, len(centres)))
    placed = model.transform(df).withColumnRenamed("cluster", "_micro").join(labels, "_micro").drop("_micro")
    return placed, merges


def bisect(df: DataFrame, n_clusters: int, seed: int = 0, features: str = "features") -> DataFrame:
    """Rows with a ``cluster`` label from the top down: the widest cluster is cut in two until there are enough.

    Every cut is a distributed fit, so neither rows nor clusters have a limit.
    """
    model = BisectingKMeans(k=n_clusters, seed=seed, featuresCol=features, predictionCol="cluster").fit(df.select(features))
    return model.transform(df).withColumn("cluster", F.col("cluster").cast("bigint"))
