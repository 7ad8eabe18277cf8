"""Logistic regression whose weights are too many for one machine.

Spark's own solver adds up a gradient as wide as the vocabulary and sends it to the
driver at every evaluation.  Here rows lie in blocks and weights in ranges of terms.  A
range sends each block the weights of the block's own terms, the block answers with
their share of the gradient, and only loss and inner products reach the driver, which
is all that L-BFGS needs to choose the next point.  The function, its scaling, the line
search and the stopping rules are those of ``classify.logistic``, so the points are too.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector, Vector
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loomstat.operators.batches import parts_for
from loomstat.session import cut_lineage, shared_dir

BLOCK_ENTRIES, RANGE_TERMS = 1 << 22, 1 << 16  # entries of a block, weights of a range
MEMORY = 10  # steps that L-BFGS remembers
SAME = 1e-14  # spread of a column, as a share of its mean, that is rounding only
_WEIGHTS = "part int, w array<double>"


class _Stuck(Exception):
    """A line search that found no step."""


class WideLogistic(Estimator, HasFeaturesCol, HasLabelCol):
    """Mean log-loss of labels 0 and 1 plus ``l2 / 2 |w|^2``, over vectors of any width."""

    def __init__(self, l2: float = 0.0, max_iter: int = 100, tol: float = 1e-6, features: str = "features", label: str = "label"):
        super().__init__()
        self.l2, self.max_iter, self.tol = l2, max_iter, tol
        self._set(featuresCol=features, labelCol=label)

    def _fit(self, df: DataFrame) -> WideLogisticModel:
        rows = df.select(F.col(self.getLabelCol()).cast("double").alias("label"), F.col(self.getFeaturesCol()).alias("v"))
        labels = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not labels or not set(labels) <= {0.0, 1.0}:
            raise ValueError(f"labels must be 0 and 1, not {sorted(labels, key=str)[:5]}")
        size = rows.first()["v"].size
        if len(labels) == 1:
            none = df.sparkSession.createDataFrame([], _WEIGHTS)
            return WideLogisticModel(none, max(size, 1), 1, math.inf if 1.0 in labels else -math.inf, [0.0], self.getFeaturesCol())
        solver = _Ranges(rows, size, sum(labels.values()), self.l2)
        try:
            at, history = _minimise(solver, math.log(labels[1.0] / labels[0.0]), self.max_iter, self.tol)
            table, intercept = solver.weights(at)
        finally:
            solver.drop()
        return WideLogisticModel(table, solver.width, solver.ranges, intercept, history, self.getFeaturesCol())


class WideLogisticModel(Model, HasFeaturesCol):
    """Weights as a table (part, w: those of ``width`` terms), the intercept, and the function's value after each round."""

    def __init__(self, table: DataFrame, width: int, ranges: int, intercept: float, history: list[float], features: str = "features"):
        super().__init__()
        self.table, self.width, self.ranges, self.intercept, self.history = table, width, ranges, intercept, history
        self._set(featuresCol=features)

    def weights(self) -> DataFrame:
        """(idx, coefficient) of every term."""
        cells = self.table.select("part", F.posexplode("w").alias("pos", "coefficient"))
        return cells.select((F.col("part") * self.width + F.col("pos")).alias("idx"), "coefficient")

    def _transform(self, df: DataFrame) -> DataFrame:
        """Blocks of rows ask the ranges for the weights of their own terms."""
        spark, width, ranges, intercept = df.sparkSession, self.width, self.ranges, self.intercept
        at, known = df.columns.index(self.getFeaturesCol()), self.table.count()
        vectors = df.select(self.getFeaturesCol())
        first = vectors.first()
        parts, wide = _parts(vectors), first[0].size if first else 0
        held = _blocks(df, parts, at)

        def ask(part):
            for block, (_, (_, _, _, _, terms)) in part:
                cuts = np.searchsorted(terms, np.arange(ranges + 1) * width)
                for k in range(ranges):
                    yield k, ("asked", (block, terms[cuts[k] : cuts[k + 1]] - k * width))

        def reply(part):
            for k, kinds in _grouped(part).items():
                for block, own in kinds["asked"]:
                    yield block, ("weights", (k, kinds["held"][0][own] if known else np.zeros(len(own))))

        def score(part):
            for kinds in _grouped(part).values():
                rows, sizes, col, weight, terms = kinds["block"][0]
                w = np.concatenate([body[1] for body in sorted(kinds["weights"], key=lambda body: body[0])])
                ends, idx = np.cumsum(sizes), terms[col]
                for row, m, size, end in zip(rows, _sums(sizes, weight * w[col]) + intercept, sizes, ends):
                    own = slice(end - size, end)
                    yield (*row[:at], SparseVector(wide, idx[own], weight[own]), *row[at:], float(m))

        range_parts = min(ranges, 4 * spark.sparkContext.defaultParallelism)
        kept = self.table.rdd.map(lambda r: (r["part"], ("held", np.array(r["w"])))).partitionBy(range_parts)
        replies = _meet(held.mapPartitions(ask), range_parts, kept).mapPartitions(reply)
        schema = StructType([*df.schema.fields, StructField("_m", DoubleType())])
        scored = spark.createDataFrame(_meet(replies, parts, held).mapPartitions(score), schema, verifySchema=False)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_m")))
        return scored.select(
            *df.columns,
            array_to_vector(F.array(-F.col("_m"), F.col("_m"))).alias("rawPrediction"),
            array_to_vector(F.array(F.lit(1.0) - p, p)).alias("probability"),
            (F.col("_m") > 0).cast("double").alias("prediction"),
        )


# ---- L-BFGS on inner products ------------------------------------------------------


@dataclass
class _Point:
    """A point and those before it that L-BFGS remembers, newest first."""

    rows: list[RDD]  # x and g of each, a range of terms in a row
    b: list[tuple[float, float]]  # the intercept's part of them
    value: float
    dots: np.ndarray  # products of g, the steps between the points and the slopes' changes along them

    def forget(self) -> None:
        self.rows, self.b, self.dots = self.rows[:1], self.b[:1], self.dots[:1, :1]

    def slope_norm(self) -> float:
        return math.sqrt(self.dots[0, 0])


def _minimise(solver: _Ranges, intercept: float, max_iter: int, tol: float) -> tuple[_Point, list[float]]:
    """Rounds until the value or the slope has settled, ``max_iter`` of them at most."""
    at = solver.start(intercept)
    first, recent, history, turn, failed = at.value, [math.inf], [at.value], 0, False
    while turn < max_iter and abs(at.value - max(recent)) > tol * abs(first) and at.slope_norm() > max(tol * abs(at.value), 1e-8):
        try:
            new = _step(solver, at, turn)
        except _Stuck:
            if failed:
                break
            for old in at.rows[1:]:
                old.unpersist()
            at.forget()
            failed = True
            continue
        for old in at.rows[len(new.rows) - 1 :]:
            old.unpersist()
        at, turn, failed = new, turn + 1, False
        recent = [*recent, at.value][-20:]
        history.append(at.value)
    return at, history


def _direction(dots: np.ndarray, known: int) -> np.ndarray:
    """The direction as shares of g, the ``known`` steps and the slopes' changes along them (both newest first)."""
    way = np.zeros(2 * known + 1)
    way[0] = 1.0
    s, y = range(1, known + 1), range(known + 1, 2 * known + 1)
    if known and not dots[s[0], y[0]] >= 0:
        raise _Stuck
    share = np.zeros(known)
    for i in range(known):
        share[i] = dots[s[i]] @ way / dots[s[i], y[i]]
        way[y[i]] -= share[i]
    if known:
        way *= dots[s[0], y[0]] / dots[y[0], y[0]]
    for i in reversed(range(known)):
        way[s[i]] += share[i] - dots[y[i]] @ way / dots[s[i], y[i]]
    if not np.isfinite(way).all():
        raise _Stuck
    return -way


def _step(solver: _Ranges, at: _Point, turn: int) -> _Point:
    """The next point: a step that meets the strong Wolfe conditions."""
    way = _direction(at.dots, len(at.rows) - 1)
    fall = float(at.dots[0] @ way)
    if fall > 0:
        raise _Stuck
    tried: list[_Point] = []

    def phi(t: float) -> tuple[float, float, float]:
        for old in tried:
            old.rows[0].unpersist()
        tried[:] = [solver.move(at, way, t)]
        return t, tried[0].value, tried[0].dots[0, 1] / t

    try:
        t = _line_search(phi, at.value, fall, 1.0 if turn else 1.0 / math.sqrt(way @ at.dots @ way))
        if t * at.slope_norm() < 1e-10:
            raise _Stuck
    except _Stuck:
        for old in tried:
            old.rows[0].unpersist()
        raise
    return tried[0]


def _line_search(phi, value: float, fall: float, t: float) -> float:
    """The step last tried by ``phi`` (step -> step, value, slope), once it lowers the value and the slope enough."""
    low = (0.0, value, fall)
    for i in range(10):
        new = phi(t)
        if not math.isfinite(new[1]):
            t /= 2
            continue
        if new[1] > value + 1e-4 * t * fall or (i and new[1] >= low[1]):
            return _zoom(phi, value, fall, low, new)
        if abs(new[2]) <= 0.9 * abs(fall):
            return t
        if new[2] >= 0:
            return _zoom(phi, value, fall, new, low)
        low, t = new, t * 1.5
    raise _Stuck


def _zoom(phi, value: float, fall: float, low: tuple, high: tuple) -> float:
    for _ in range(10):
        new = phi(_between(*sorted((low, high))))
        if new[1] > value + 1e-4 * new[0] * fall or new[1] >= low[1]:
            high = new
            continue
        if abs(new[2]) <= 0.9 * abs(fall):
            return new[0]
        if new[2] * (high[0] - low[0]) >= 0:
            high = low
        low = new
    raise _Stuck


def _between(left: tuple, right: tuple) -> float:
    """Where the cubic through two values and slopes is least, not too near either end."""
    width = right[0] - left[0]
    d1 = left[2] + right[2] - 3 * (left[1] - right[1]) / (left[0] - right[0])
    inner = d1 * d1 - left[2] * right[2]
    d2 = math.sqrt(inner) if inner >= 0 else math.nan
    below = right[2] - left[2] + 2 * d2
    t = right[0] - width * (right[2] + d2 - d1) / below if below else math.nan
    return min(max(t, left[0] + 0.1 * width), left[0] + 0.9 * width) if t == t else t


# ---- blocks of rows, ranges of terms -----------------------------------------------


def _meet(sent: RDD, parts: int, *kept: RDD) -> RDD:
    """Rows of ``kept``, which stay where they are, with the rows sent to them by key."""
    placed = sent.partitionBy(parts).mapPartitions(lambda part: part, preservesPartitioning=True)
    for rdd in kept:
        placed = rdd.union(placed)
    return placed


def _basis(xs: list, gs: list) -> list:
    """g, the steps and the changes of points that are given newest first."""
    return [gs[0], *(new - old for new, old in zip(xs, xs[1:])), *(new - old for new, old in zip(gs, gs[1:]))]


def _grouped(part) -> dict:
    """key -> kind -> bodies, of rows (key, (kind, body))."""
    out: dict = defaultdict(lambda: defaultdict(list))
    for key, (kind, body) in part:
        out[key][kind].append(body)
    return out


def _cells(v: Vector) -> tuple[np.ndarray, np.ndarray]:
    return (v.indices, v.values) if isinstance(v, SparseVector) else (np.arange(v.size), v.toArray())


def _sums(sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of runs of ``sizes`` values, in order."""
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=values, minlength=len(sizes))


def _parts(vectors: DataFrame) -> int:
    """Parts of some ``BLOCK_ENTRIES`` entries."""
    entries = vectors.rdd.map(lambda r: len(_cells(r[0])[0])).sum()
    return parts_for(vectors, entries, BLOCK_ENTRIES)


def _blocks(df: DataFrame, parts: int, at: int) -> RDD:
    """One block per part of the rows with a vector at place ``at``: the rows' other values, sizes, local terms, weights, terms in order."""

    def pile(source, turn, rows):
        idx, weight = zip(*(_cells(row[at]) for row in rows))
        others = [(*row[:at], *row[at + 1 :]) for row in rows]
        return source, turn, others, np.array([len(own) for own in idx]), np.concatenate(idx), np.concatenate(weight)

    def deal(part):
        source, turn, piles, entries = TaskContext.get().partitionId(), 0, defaultdict(list), 0
        for n, row in enumerate(part, source):
            piles[n % parts].append(row)
            entries += len(_cells(row[at])[0])
            if entries >= BLOCK_ENTRIES:
                yield from ((block, pile(source, turn, rows)) for block, rows in piles.items())
                turn, piles, entries = turn + 1, defaultdict(list), 0
        yield from ((block, pile(source, turn, rows)) for block, rows in piles.items())

    def joined(part):
        got = defaultdict(list)
        for block, body in part:
            got[block].append(body)
        for block, bodies in got.items():
            bodies.sort(key=lambda body: body[:2])
            sizes, idx, weight = (np.concatenate([body[i] for body in bodies]) for i in (3, 4, 5))
            terms, col = np.unique(idx, return_inverse=True)
            yield block, ("block", ([row for body in bodies for row in body[2]], sizes, col.astype(np.int32), weight, terms))

    return df.rdd.mapPartitions(deal).partitionBy(parts).mapPartitions(joined, preservesPartitioning=True)


def _labelled(part):
    """Blocks with their labels in place of their rows."""
    for block, (kind, (rows, *rest)) in part:
        yield block, (kind, (np.array([row[0] for row in rows]), *rest))


class _Ranges:
    """The function over blocks of rows; ``rows`` of a point hold its vectors, a range of terms in each."""

    def __init__(self, rows: DataFrame, size: int, n: int, l2: float):
        cores = rows.sparkSession.sparkContext.defaultParallelism
        self.spark, self.n, self.l2 = rows.sparkSession, n, l2
        self.width = max(1 << 10, min(RANGE_TERMS, math.ceil(size / cores)))
        self.ranges = max(1, math.ceil(size / self.width))
        self.parts, self.range_parts = _parts(rows.select("v")), min(self.ranges, 4 * cores)
        blocks = _blocks(rows, self.parts, 1).mapPartitions(_labelled, preservesPartitioning=True)
        self.blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        self.turn = 0
        shared_dir(self.spark)
        self.fixed = self._fixed(size).persist(StorageLevel.MEMORY_AND_DISK)

    def _fixed(self, size: int) -> RDD:
        """Per range: the columns' means, one over their spread, the penalty's curvature, and each block's terms."""
        width, ranges, n, l2 = self.width, self.ranges, self.n, self.l2

        def moments(part):
            for block, (_, body) in part:
                _, _, col, weight, terms = body
                count = np.bincount(col, minlength=len(terms)).astype(float)
                mean = np.bincount(col, weights=weight, minlength=len(terms)) / np.maximum(count, 1)
                spread = np.bincount(col, weights=(weight - mean[col]) ** 2, minlength=len(terms))
                cuts = np.searchsorted(terms, np.arange(ranges + 1) * width)
                for k in range(ranges):
                    own = slice(cuts[k], cuts[k + 1])
                    yield k, ("moments", (block, (terms[own] - k * width).astype(np.int32), count[own], mean[own], spread[own]))

        def joined(part):
            for k, kinds in _grouped(part).items():
                wide = max(min(width, size - k * width), 0)
                count, mean, spread, where = np.zeros(wide), np.zeros(wide), np.zeros(wide), {}
                for block, at, c, m, s in sorted(kinds["moments"], key=lambda body: body[0]):
                    off, total = m - mean[at], count[at] + c
                    spread[at] += s + off**2 * count[at] * c / total
                    mean[at] += off * c / total
                    count[at], where[block] = total, at
                variance = (spread + mean**2 * count * (n - count) / n) / max(n - 1, 1)
                mean *= count / n
                std = np.sqrt(variance)
                std[std <= SAME * np.abs(mean)] = 0.0
                inverse = np.divide(1.0, std, out=np.zeros(wide), where=std > 0)
                yield k, ("fixed", (mean, inverse, l2 * inverse**2, where))

        return _meet(self.blocks.mapPartitions(moments), self.range_parts).mapPartitions(joined, preservesPartitioning=True)

    def start(self, intercept: float) -> _Point:
        def nil(part):
            for k, (_, (mean, *_)) in part:
                zero = np.zeros(len(mean))
                yield k, ("point", (0, zero, zero))

        origin = self.fixed.mapPartitions(nil, preservesPartitioning=True)
        return self.move(_Point([origin], [(intercept, 0.0)], 0.0, np.zeros((1, 1))), np.zeros(1), 0.0, 0)

    def move(self, at: _Point, shares: np.ndarray, t: float, memory: int = MEMORY) -> _Point:
        """The point ``t`` times the direction away from ``at``; ``shares`` are the direction's in g, the steps and the changes."""
        n, width, ranges = self.n, self.width, self.ranges
        self.turn += 1
        turn, b = self.turn, at.b[0][0] + t * float(shares @ _basis(*zip(*at.b)))

        def moved(points) -> tuple[np.ndarray, list, list]:
            _, xs, gs, *_ = zip(*sorted(points, key=lambda body: -body[0]))
            way = np.zeros(len(xs[0]))
            for share, v in zip(shares, _basis(xs, gs)):
                if share:
                    way += share * v
            return xs[0] + t * way, xs, gs

        def send(part):
            for k, kinds in _grouped(part).items():
                mean, inverse, _, where = kinds["fixed"][0]
                w = moved(kinds["point"])[0] * inverse
                centre = float(mean @ w)
                for block, own in where.items():
                    yield block, ("weights", (k, w[own], centre))

        def answer(part):
            for block, kinds in _grouped(part).items():
                label, sizes, col, weight, terms = kinds["block"][0]
                got = sorted(kinds["weights"], key=lambda body: body[0])
                w = np.concatenate([body[1] for body in got])
                m = _sums(sizes, weight * w[col]) + (b - sum(body[2] for body in got))
                e = np.exp(-np.abs(m))
                loss = float((np.maximum(m, 0.0) - label * m + np.log1p(e)).sum()) / n
                rest = (np.where(m >= 0, 1.0, e) / (1.0 + e) - label) / n
                slope = np.bincount(col, weights=weight * np.repeat(rest, sizes), minlength=len(terms))
                cuts = np.searchsorted(terms, np.arange(ranges + 1) * width)
                for k in range(ranges):
                    yield k, ("slopes", (block, slope[cuts[k] : cuts[k + 1]], loss, float(rest.sum())))

        def gather(part):
            for k, kinds in _grouped(part).items():
                mean, inverse, curve, where = kinds["fixed"][0]
                x, xs, gs = moved(kinds["point"])
                total, loss, rest = np.zeros(len(mean)), 0.0, 0.0
                for block, slope, own_loss, own_rest in sorted(kinds["slopes"], key=lambda body: body[0]):
                    total[where[block]] += slope
                    loss, rest = loss + own_loss, rest + own_rest
                g = (total - mean * rest) * inverse + curve * x
                v = np.array(_basis([x, *xs][: memory + 1], [g, *gs][: memory + 1]))
                yield k, ("point", (turn, x, g, v @ v.T, loss, rest, float(curve @ (x * x)) / 2))

        def products(part):
            for k, (_, (_, _, _, *numbers)) in part:
                yield k, *numbers

        held = self.fixed
        for old in at.rows:
            held = held.union(old)
        asked = _meet(held.mapPartitions(send), self.parts, self.blocks).mapPartitions(answer)
        rows = _meet(asked, self.range_parts, held).mapPartitions(gather, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        rows.checkpoint()
        got = sorted(rows.mapPartitions(products).collect(), key=lambda r: r[0])
        points = [(b, got[0][3]), *at.b][: memory + 1]
        basis = np.array(_basis(*zip(*points)))
        value = got[0][2] + sum(r[4] for r in got)
        rows = RDD(rows._jrdd, rows.ctx, rows._jrdd_deserializer)  # holds on to nothing that it came from
        return _Point([rows, *at.rows][: memory + 1], points, value, sum(r[1] for r in got) + np.outer(basis, basis))

    def weights(self, at: _Point) -> tuple[DataFrame, float]:
        """The table of weights for rows as they came, and the intercept."""

        def scaled(part):
            for k, kinds in _grouped(part).items():
                mean, inverse, *_ = kinds["fixed"][0]
                w = kinds["point"][0][1] * inverse
                yield k, w.tolist(), float(mean @ w)

        rows = self.fixed.union(at.rows[0]).mapPartitions(scaled)
        table = cut_lineage(self.spark.createDataFrame(rows, _WEIGHTS + ", centre double"))
        for old in at.rows:
            old.unpersist()
        centre = math.fsum(r["centre"] for r in table.select("centre").collect())
        return table.select("part", "w"), at.b[0][0] - centre

    def drop(self) -> None:
        self.blocks.unpersist()
        self.fixed.unpersist()
