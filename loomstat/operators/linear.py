"""Linear models.

Squared loss depends on the rows only through the sums of products of
``[1, x1, ..., xd, y]``.  One aggregation collects those sums (a small matrix per
group), and every squared-loss learner, its training curve and its scores on any
union of groups follow from them without reading the rows again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.functions.hashing import hash52, uniform
from loomstat.functions.maths import linear_score
from loomstat.operators.batches import matrix, summed

@dataclass
class LinearFit:
    """``b + w . x``; ``losses`` holds one value per epoch for iterative fits."""

    b: float
    w: np.ndarray
    losses: list[float] | None = None

    def score(self, xs: list[str]) -> Column:
        return linear_score([F.col(x) for x in xs], list(self.w), self.b)

    def frame(self, spark, xs: list[str]) -> DataFrame:
        """(term, value) with the intercept as term ``b``."""
        rows = [("b", float(self.b))] + [(x, float(v)) for x, v in zip(xs, self.w)]
        return spark.createDataFrame(rows, "term string, value double")


@dataclass
class Gram:
    """Sums of products of ``[1, x - shift, y - shift]`` over the complete rows of a group."""

    sums: np.ndarray
    shift: np.ndarray  # one value per x, then y
    dropped: int = 0  # rows left out because a value was NULL

    def __add__(self, other: "Gram") -> "Gram":
        return Gram(self.sums + other.sums, self.shift, self.dropped + other.dropped)

    def __sub__(self, other: "Gram") -> "Gram":
        return Gram(self.sums - other.sums, self.shift, self.dropped - other.dropped)

    @property
    def n(self) -> float:
        return float(self.sums[0, 0])

    def centred(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Sums of squares and products about these rows' own means."""
        m = self.sums[0, 1:] / max(self.n, 1.0)
        c = self.sums[1:, 1:] - self.n * np.outer(m, m)
        return c[:-1, :-1], c[:-1, -1], float(c[-1, -1])

    def _with_intercept(self, w: np.ndarray, losses=None) -> LinearFit:
        means = self.sums[0, 1:] / max(self.n, 1.0) + self.shift
        return LinearFit(float(means[-1] - means[:-1] @ w), w, losses)

    def least_squares(self, l2: float = 0.0) -> LinearFit:
        """Minimise ``|r|^2 + l2 |w|^2``; the intercept is not penalised.

        Columns are solved on one scale.  Constant and collinear columns share the
        least-norm weights; no complete row gives zeros.
        """
        xx, xy, _ = self.centred()
        a = xx + l2 * np.eye(len(xx))
        scale = np.sqrt(np.maximum(np.diag(a), 0.0))
        scale[scale <= 1e-10 * max(1.0, scale.max(initial=0.0))] = np.inf  # a constant column gets weight 0
        w = np.linalg.lstsq(a / np.outer(scale, scale), xy / scale, rcond=1e-11)[0] / scale
        return self._with_intercept(w)

    def coordinate_descent(self, l1: float, l2: float = 0.0, rounds: int = 1000, tol: float = 1e-12) -> LinearFit:
        """Minimise ``|r|^2 / 2n + l1 |w|_1 + l2/2 |w|^2``."""
        xx, xy, _ = self.centred()
        a, c = xx / max(self.n, 1.0), xy / max(self.n, 1.0)
        w = np.zeros(len(c))
        for _ in range(rounds):
            before = w.copy()
            for j in range(len(w)):
                rho = c[j] - a[j] @ w + a[j, j] * w[j]
                w[j] = np.sign(rho) * max(abs(rho) - l1, 0.0) / (a[j, j] + l2) if a[j, j] + l2 > 0 else 0.0
            if np.max(np.abs(w - before), initial=0.0) <= tol * max(1.0, np.max(np.abs(w), initial=0.0)):
                break
        return self._with_intercept(w)

    def raw(self) -> np.ndarray:
        """The sums with the shift taken out again."""
        d = len(self.sums)
        t = np.eye(d)
        t[1:, 0] = self.shift
        return t @ self.sums @ t.T

    def sse(self, fit: LinearFit) -> float:
        v = np.concatenate([[-(fit.b + fit.w @ self.shift[:-1] - self.shift[-1])], -fit.w, [1.0]])
        return float(v @ self.sums @ v)

    def scores(self, fit: LinearFit) -> dict[str, float]:
        """mse and r2 of a fit on these rows; for a constant label r2 is 1 without errors, else 0."""
        sse, (_, _, sst) = self.sse(fit), self.centred()
        n = max(self.n, 1.0)
        if sst <= 1e-12 * max(1.0, abs(self.sums[-1, -1])):
            return {"mse": sse / n, "r2": 1.0 if sse <= 1e-12 * n else 0.0}
        return {"mse": sse / n, "r2": 1.0 - sse / sst}


def grams(df: DataFrame, xs: list[str], y: str, by: list[str]) -> dict[tuple, Gram]:
    """One Gram matrix per group, in one pass after the means are known.

    Groups come from parameters (folds, sizes, batches); for groups that come from
    the data use ``group_fits``, which leaves them in a table.  Rows are shifted by
    the overall means to keep the sums exact.  A row with a NULL among its values
    takes no part; ``dropped`` counts them.
    """
    table, shift, cells = _gram_table(df, xs, y, by)
    return {tuple(row[b] for b in by): _gram_of(row, shift, cells) for row in table.collect()}


def _gram_table(df: DataFrame, xs: list[str], y: str, by: list[str]):
    """(by..., dropped, g_i_j...): sums of products per group, with the shift and the cells."""
    cols = [*xs, y]
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    means = df.where(whole).agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shift = np.array([float(means[i] or 0.0) for i in range(len(cols))])
    z = [F.lit(1.0)] + [F.col(c).cast("double") - F.lit(float(s)) for c, s in zip(cols, shift)]
    cells = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    sums = [F.coalesce(F.sum(F.when(whole, z[i] * z[j])), F.lit(0.0)).alias(f"g_{i}_{j}") for i, j in cells]
    return df.groupBy(*by).agg(F.count_if(~whole).alias("dropped"), *sums), shift, cells


def _gram_of(row, shift: np.ndarray, cells) -> Gram:
    size = len(shift) + 1
    g = np.zeros((size, size))
    for i, j in cells:
        g[i, j] = g[j, i] = row[f"g_{i}_{j}"]
    return Gram(g, shift, row["dropped"])


def group_fits(df: DataFrame, xs: list[str], y: str, by: list[str], l2: float = 0.0) -> DataFrame:
    """(by..., n, dropped, b, w): least squares per group, for any number of groups, solved where the sums are."""
    table, shift, cells = _gram_table(df, xs, y, by)

    def solved(batches):
        for batch in batches:
            rows = batch.to_pylist()
            fits = [(g, g.least_squares(l2)) for g in (_gram_of(r, shift, cells) for r in rows)]
            made = [
                *[batch.column(i) for i in range(len(by))],
                pa.array([int(g.n) for g, _ in fits], pa.int64()),
                pa.array([g.dropped for g, _ in fits], pa.int64()),
                pa.array([float(f.b) for _, f in fits]),
                pa.array([f.w.tolist() for _, f in fits], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(made, [*by, "n", "dropped", "b", "w"])

    found = [("n", T.LongType()), ("dropped", T.LongType()), ("b", T.DoubleType()), ("w", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*(table.schema[b] for b in by), *(T.StructField(n, t) for n, t in found)])
    return table.mapInArrow(solved, schema)


def gram(df: DataFrame, xs: list[str], y: str) -> Gram:
    return grams(df, xs, y, [])[()]


def combined(parts) -> Gram:
    parts = list(parts)
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def gradient_descent(g: Gram, eta: float, num_iter: int) -> LinearFit:
    """Full-batch descent on the mean squared error from zero weights.

    Each epoch records the loss before its update: ``w <- w - eta * 2 * gradient``.
    """
    s = g.raw()
    v = np.zeros(len(s) - 1)  # intercept and weights
    losses = []
    for _ in range(num_iter):
        slope = s[:-1, :-1] @ v - s[:-1, -1]
        losses.append(float((v @ s[:-1, :-1] @ v - 2 * v @ s[:-1, -1] + s[-1, -1]) / g.n))
        v = v - eta * 2.0 * slope / g.n
    return LinearFit(float(v[0]), v[1:], losses)


def minibatch_descent(batches: list[Gram], eta: float, num_iter: int) -> LinearFit:
    """Stochastic descent: one update per batch, all batches in turn per epoch.

    A batch enters the update through its Gram matrix alone, so one pass over the
    rows serves every epoch.
    """
    raws = [(b.raw(), b.n) for b in batches]
    v = np.zeros(len(raws[0][0]) - 1)
    losses = []
    for _ in range(num_iter):
        loss, rows = 0.0, 0.0
        for s, n in raws:
            loss += float(v @ s[:-1, :-1] @ v - 2 * v @ s[:-1, -1] + s[-1, -1])
            rows += n
            v = v - eta * 2.0 * (s[:-1, :-1] @ v - s[:-1, -1]) / n
        losses.append(loss / rows)
    return LinearFit(float(v[0]), v[1:], losses)


def hashed_batches(df: DataFrame, key: str | Column, xs: list[str], y: str, batches: int, seed: int) -> list[Gram]:
    """Gram matrices of ``batches`` random batches of about equal size."""
    numbered = df.withColumn("_batch", F.floor(uniform(seed, key) * F.lit(batches)).cast("int"))
    parts = grams(numbered, xs, y, ["_batch"])
    return [parts[k] for k in sorted(parts)]


def lasso(g: Gram, alpha: float) -> LinearFit:
    return g.coordinate_descent(alpha)


def elastic_net(g: Gram, alpha: float, l1_ratio: float) -> LinearFit:
    return g.coordinate_descent(alpha * l1_ratio, alpha * (1.0 - l1_ratio))


@dataclass
class RansacFit:
    fit: LinearFit
    best_trial: int
    inliers: int
    threshold: float
    candidate: LinearFit

    def inlier(self, xs: str | list[str], y: str) -> Column:
        return _within(_names(xs), y, self.candidate, self.threshold)


def _names(xs: str | list[str]) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def _within(xs: list[str], y: str, fit: LinearFit, threshold: float) -> Column:
    return F.abs(F.col(y) - fit.score(xs)) <= F.lit(float(threshold))


def trial_turns(trials: int) -> list[tuple[int, int]]:
    """(factor, shift) of each trial: a row's 52-bit hash h becomes (h * factor + shift) mod 2**52, the trial's own draw."""
    return [((0x5851F42D4C957F * (2 * t + 1)) % 2**52, (0x14057B7EF767814F * (t + 1)) % 2**52) for t in range(trials)]


def _trial_rows(df: DataFrame, xs: list[str], y: str, *more: Column) -> DataFrame:
    known = df.dropna(subset=[*xs, y])
    return known.select(F.array(F.lit(1.0), *[F.col(c).cast("double") for c in [*xs, y]]).alias("v"), *more)


def trial_fits(df: DataFrame, key: str, xs: str | list[str], y: str, max_trials: int, min_samples: float, seed: int) -> list[LinearFit | None]:
    """Least squares on a random share of the rows for each trial, all in one pass; None where a share decides no line.

    Each row is hashed once and its hash turned per trial.  A task adds up one small
    matrix of products per trial, so one row per matrix entry and task is moved.
    """
    xs = _names(xs)
    turns = np.array(trial_turns(max_trials), np.uint64)
    bound, mask, width = np.uint64(min(max(round(min_samples * 2**52), 0), 2**52)), np.uint64(2**52 - 1), len(xs) + 2
    up, low = np.triu_indices(width)
    rows = _trial_rows(df, xs, y, hash52(seed, key).alias("h"))

    def sums(batches):
        out = np.zeros((max_trials, len(up)))
        for batch in batches:
            v_all, h_all = matrix(batch.column(0)), batch.column(1).to_numpy().astype(np.uint64)
            for s in range(0, len(v_all), 8192):
                v, h = v_all[s : s + 8192], h_all[s : s + 8192]
                drawn = ((h[:, None] * turns[:, 0] + turns[:, 1]) & mask) < bound
                out += drawn.astype(np.float64).T @ (v[:, up] * v[:, low])
        return out.ravel()

    fits = []
    for cells in summed(rows, sums, max_trials * len(up)).reshape(max_trials, -1):
        g = np.zeros((width, width))
        g[up, low] = g[low, up] = cells
        n = max(g[0, 0], 1.0)
        centred = g[1:, 1:] - np.outer(g[0, 1:], g[0, 1:]) / n  # sums of products about the means
        if np.linalg.matrix_rank(centred[:-1, :-1], hermitian=True) < len(xs):
            fits.append(None)
            continue
        w = np.linalg.solve(centred[:-1, :-1], centred[:-1, -1])
        fits.append(LinearFit(float((g[0, -1] - w @ g[0, 1:-1]) / n), w))
    return fits


def inlier_counts(df: DataFrame, xs: str | list[str], y: str, fits: list[LinearFit | None], threshold: float) -> list[int]:
    """How many rows lie within ``threshold`` of each fit, all in one pass."""
    some = [f for f in fits if f is not None]
    if not some:
        return [0] * len(fits)
    w = np.array([[f.b, *f.w] for f in some])

    def counts(batches):
        out = np.zeros(len(w))
        for batch in batches:
            v_all = matrix(batch.column(0))
            for s in range(0, len(v_all), 8192):
                v = v_all[s : s + 8192]
                out += (np.abs(v[:, -1:] - v[:, :-1] @ w.T) <= threshold).sum(axis=0)
        return out

    found = iter(summed(_trial_rows(df, _names(xs), y), counts, len(w)))
    return [0 if f is None else int(next(found)) for f in fits]


def ransac(df: DataFrame, key: str, xs: str | list[str], y: str, max_trials: int, min_samples: float, threshold: float, seed: int) -> RansacFit:
    """The trial fit with most inliers (first trial on ties), fitted again on its inliers."""
    xs = _names(xs)
    fits = trial_fits(df, key, xs, y, max_trials, min_samples, seed)
    counts = inlier_counts(df, xs, y, fits, threshold)
    usable = [t for t, f in enumerate(fits) if f is not None]
    if not usable:
        raise ValueError("no trial decides a fit: too few rows or no spread")
    best = max(usable, key=lambda t: (counts[t], -t))
    final = gram(df.where(_within(xs, y, fits[best], threshold)), xs, y).least_squares()
    return RansacFit(final, best, counts[best], threshold, fits[best])


def logistic_descent(df: DataFrame, xs: list[str], y: str, eta: float, num_iter: int) -> LinearFit:
    """Full-batch descent on the mean log-loss from zero weights.

    The rows are kept once; an epoch adds up loss and slope inside each task and
    moves one row per task.  Rows with a NULL take no part.
    """
    vec = F.array(F.lit(1.0), *[F.col(x).cast("double") for x in xs], F.col(y).cast("double"))
    rows = df.dropna(subset=[*xs, y]).select(vec.alias("v")).persist()
    try:
        v, losses = np.zeros(len(xs) + 1), []
        for _ in range(num_iter):

            def epoch(batches, v=v):
                total = np.zeros(len(v) + 2)
                for batch in batches:
                    m = matrix(batch.column(0))
                    x, label = m[:, :-1], m[:, -1]
                    z = x @ v
                    total[0] += len(m)
                    total[1] += (np.logaddexp(0.0, z) - label * z).sum()
                    total[2:] += (1.0 / (1.0 + np.exp(-z)) - label) @ x
                return total

            total = summed(rows, epoch, len(v) + 2)
            n = max(total[0], 1.0)
            losses.append(total[1] / n)
            v = v - eta * total[2:] / n
        return LinearFit(float(v[0]), v[1:], losses)
    finally:
        rows.unpersist()
