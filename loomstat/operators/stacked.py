"""Many penalised logistic regressions in the same passes over the rows.

Members differ in the class they tell from the rest, the penalty, the fold they leave out
and the bootstrap they see.  A pass adds up loss, slope and curvature of every member that
has not settled, inside the tasks; Newton's steps, halved where the loss did not fall, are
then taken for all of them.  So a thousand bags, or every fold of every penalty of every
class, cost as many passes as one fit.

A member's loss is the mean over its rows (weighted by draws) plus ``l2 / 2 |w|^2``, the bias
left out.  Rows with a NULL or NaN take no part.  The curvature is d x d per member: meant
for up to some hundred features.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions.hashing import poisson_thresholds
from loomstat.operators.batches import evened, matrix, packed, summed, unpacked
from loomstat.session import cut_lineage

ROWS, MEMBERS = 256, 64  # what a task works on at a time
BEND = 1 / (6 * math.sqrt(3))  # the logistic function's second derivative is nowhere larger
_CELL_BITS = 12


@dataclass(frozen=True)
class Member:
    """``positive``: the label that counts as 1; ``fold``: rows left out; ``draw``: number of its bootstrap, None = every row once."""

    positive: float = 1.0
    l2: float = 0.0
    fold: int | None = None
    draw: int | None = None


@dataclass
class StackedFit:
    """``weights``: one row per member, the bias first; ``settled``: whose slope vanished."""

    members: list[Member]
    weights: np.ndarray
    losses: np.ndarray
    settled: np.ndarray
    passes: int = 0
    slopes: list[float] = field(default_factory=list)

    def probabilities(self, df: DataFrame, features: list[str]) -> DataFrame:
        """``df`` with ``p``, the mean over all members of the chance of the positive class."""
        w = self.weights

        def run(batches):
            for batch in batches:
                x = _biased(matrix(batch.column(batch.num_columns - 1)))
                p = np.zeros(len(x))
                for at in range(0, len(x), ROWS):
                    for k in range(0, len(w), MEMBERS):
                        z = x[at : at + ROWS] @ -w[k : k + MEMBERS].T
                        np.clip(z, -500, 500, out=z)
                        np.exp(z, out=z)
                        z += 1.0
                        p[at : at + ROWS] += np.reciprocal(z, out=z).sum(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p / len(w))], [*batch.schema.names[:-1], "p"])

        schema = df.schema.add("p", "double")
        return df.select("*", F.array(*[F.col(c).cast("double") for c in features]).alias("_x")).mapInArrow(run, schema)


def _biased(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones((len(x), 1)), x], axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit words."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def draws(h: np.ndarray, numbers: np.ndarray, mean: float) -> np.ndarray:
    """How often each bootstrap (column) draws each row: Poisson counts from the row's hash, turned per bootstrap."""
    salt = _mixed((numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    word = h[:, None] ^ salt[None, :]
    part = word >> np.uint64(30)  # ``_mixed`` in place
    for factor, shift in ((0xBF58476D1CE4E5B9, 27), (0x94D049BB133111EB, 31)):
        word ^= part
        word *= np.uint64(factor)
        np.right_shift(word, np.uint64(shift), out=part)
    word ^= part
    np.right_shift(word, np.uint64(64 - _CELL_BITS), out=part)
    out = _likely_counts(mean).take(part.view(np.int64))
    unsure = np.flatnonzero(out < 0)
    out.ravel()[unsure] = np.searchsorted(np.array(poisson_thresholds(mean)), (word.ravel()[unsure] >> np.uint64(11)).astype(np.float64) / 2.0**53, side="right")
    return out


@cache
def _likely_counts(mean: float) -> np.ndarray:
    """The count by the first bits of a word, -1 where a threshold lies between words of these bits."""
    low = np.arange(2**_CELL_BITS) / 2.0**_CELL_BITS
    bounds = np.array(poisson_thresholds(mean))
    first, last = (np.searchsorted(bounds, v, side="right") for v in (low, low + 2.0**-_CELL_BITS - 2.0**-53))
    return np.where(first == last, first, -1).astype(np.float64)


def stacked_logistic(
    df: DataFrame, key: str | Column, features: list[str], label: str, members: list[Member], fold: str | None = None, max_iter: int = 50, tol: float = 1e-8, seed: int = 1, max_samples: float = 1.0
) -> StackedFit:
    """Fit all ``members``; a member is settled when no entry of its slope exceeds ``tol`` times the features' scale.

    Bootstraps draw rows by ``key`` and ``seed``, ``max_samples`` times the rows on average.
    Their steps start where the fit on every row once has settled, which is near where they end.
    """
    d = len(features) + 1
    vec = F.array(*[F.col(c).cast("double") for c in features])
    fold_of = F.col(fold).cast("int") if fold else F.lit(0)
    rows = df.select(vec.alias("x"), F.col(label).cast("double").alias("y"), fold_of.alias("fold"), F.xxhash64(F.lit(seed), key).alias("h"))
    rows = rows.where(F.col("y").isNotNull() & F.col("fold").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    packs = cut_lineage(packed(evened(rows)))
    scale, widest = _sizes(packs, unpacked(rows), d)
    start = np.zeros((len(members), d))
    plain = list(dict.fromkeys(replace(b, draw=None) for b in members if b.draw is not None))
    if 0 < len(plain) < len(members):
        near = _newton(packs, unpacked(rows), scale, widest, plain, np.zeros((len(plain), d)), max_iter, tol, max_samples)
        known = {b: w for b, w, settled in zip(plain, near.weights, near.settled) if settled}
        start = np.array([known.get(replace(b, draw=None), w) for b, w in zip(members, start)])
    fit = _newton(packs, unpacked(rows), scale, widest, members, start, max_iter, tol, max_samples)
    fit.weights = fit.weights / scale
    return fit


def _sizes(packs: DataFrame, arrays, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Per column, the bias first: the root of its mean square (1 where all are 0), and its largest entry as a multiple of that."""

    def task(batches):
        for x, *_ in arrays(batches):
            cells = [[len(x)], [(x * x).sum(axis=0)], [np.abs(x).max(axis=0)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, (pa.int64(), *[pa.list_(pa.float64())] * 2))], ["n", "s", "far"])

    cells = packs.mapInArrow(task, "n bigint, s array<double>, far array<double>")
    sums, most = ([f(F.col(c)[j]) for j in range(d - 1)] for f, c in ((F.sum, "s"), (F.max, "far")))
    n, *got = (v or 0 for v in cells.agg(F.sum("n"), *sums, *most).first())
    scale = np.append(1.0, np.sqrt(np.array(got[: d - 1]) / max(n, 1)))
    scale[~(scale > 0)] = 1.0  # solve for features of size one, for the sake of the numbers
    return scale, np.append(1.0, got[d - 1 :]) / scale


def _newton(packs: DataFrame, arrays, scale: np.ndarray, widest: np.ndarray, members: list[Member], start: np.ndarray, max_iter: int, tol: float, max_samples: float) -> StackedFit:
    """Newton's steps of all ``members`` from ``start``, on packs of (x, y, fold, h); weights are for features divided by ``scale``.

    After a step the slope is what the curvature leaves of it, and at most ``BEND / 2`` times the mean of
    (x step)^2 |x| besides.  Where this is below ``tol`` the member has settled; no pass is needed to see it.
    """
    m, d = start.shape
    cells = [(i, j) for i in range(d) for j in range(i, d)]
    up, low = np.array([c[0] for c in cells]), np.array([c[1] for c in cells])
    positive = np.array([b.positive for b in members], np.float64)
    left_out = np.array([np.nan if b.fold is None else b.fold for b in members], np.float64)  # equal to no fold
    draw = np.array([-1 if b.draw is None else b.draw for b in members], np.int64)
    l2 = np.array([b.l2 for b in members])[:, None] * np.append(0.0, np.ones(d - 1)) / scale**2
    width = 2 + d + 2 * len(cells)  # the last cells are NaN where rows are not worth the same to all

    def totals(at: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Per member of ``at``: weight of its rows, loss, slope and curvature at its weights, products of its rows."""
        chunks = [slice(k, k + MEMBERS) for k in range(0, len(at), MEMBERS)]
        alike = [len(np.unique(np.column_stack([w[c], positive[at[c]]]), axis=0)) == 1 for c in chunks]  # rows are worth the same to all

        def run(batches):
            out = np.zeros((len(at), width))
            for x_all, y_all, fold_all, h_all in arrays(batches):
                x_all = _biased(x_all) / scale
                h_all = h_all.view(np.uint64)
                for s in range(0, len(x_all), ROWS):
                    x, y, folds, h = (v[s : s + ROWS] for v in (x_all, y_all, fold_all, h_all))
                    products = x[:, up] * x[:, low]
                    for c, same in zip(chunks, alike):
                        some = at[c]
                        weight = (folds[:, None] != left_out[some]).astype(np.float64)
                        drawn = np.flatnonzero(draw[some] >= 0)
                        if len(drawn) == len(some):
                            weight *= draws(h, draw[some], max_samples)
                        elif len(drawn):
                            weight[:, drawn] *= draws(h, draw[some][drawn], max_samples)
                        one = slice(0, 1) if same else slice(None)
                        z = x @ w[c][one].T
                        t = (y[:, None] == positive[some][one]).astype(np.float64)
                        loss, p, curve = _terms(z, t)
                        part = out[c]
                        if same:
                            part += weight.T @ np.concatenate([np.ones_like(z), loss, (p - t) * x, curve * products, products], axis=1)
                        else:
                            part[:, 0] += weight.sum(axis=0)
                            part[:, 1] += (weight * loss).sum(axis=0)
                            part[:, 2 : 2 + d] += (weight * (p - t)).T @ x
                            part[:, 2 + d : 2 + d + len(cells)] += (weight * curve).T @ products
            return out.ravel()

        got = summed(packs, run, len(at) * width).reshape(-1, width)
        for c, same in zip(chunks, alike):
            if not same:
                got[c, 2 + d + len(cells) :] = np.nan
        return got

    def symmetric(values: np.ndarray) -> np.ndarray:
        out = np.empty((len(values), d, d))
        out[:, up, low] = out[:, low, up] = values
        return out

    best, loss = start.copy(), np.full(m, np.inf)
    trial, slope, step = best.copy(), np.zeros((m, d)), np.zeros((m, d))
    open_, fit = np.arange(m), StackedFit(members, best, loss, np.zeros(m, bool))
    for _ in range(max_iter):
        if not len(open_):
            break
        got = totals(open_, trial[open_])
        n = np.maximum(got[:, :1], 1e-300)
        value = got[:, 1] / n[:, 0] + (l2[open_] * trial[open_] ** 2).sum(axis=1) / 2
        better = value <= loss[open_] + 1e-12 * np.maximum(1.0, np.abs(loss[open_])) if fit.passes else np.ones(len(open_), bool)
        fit.passes += 1
        at = open_[better]
        best[at], loss[at] = trial[at], value[better]
        slope[at] = got[better, 2 : 2 + d] / n[better] + l2[at] * trial[at]
        curve, spread = (symmetric(c / n[better]) for c in np.split(got[better, 2 + d :], 2, axis=1))
        curve[:, range(d), range(d)] += l2[at] + 1e-12
        step[at] = np.linalg.solve(curve, slope[at][:, :, None])[:, :, 0] if len(at) else 0.0
        step[open_[~better]] /= 2
        done = (np.abs(slope[open_]).max(axis=1) < tol) | (np.abs(step[open_]).max(axis=1) < 1e-14)
        fit.settled[open_[done]] = True
        fit.slopes.append(float(np.abs(slope[open_]).max()))
        ahead = np.zeros(m, bool)
        left = slope[at] - np.einsum("kij,kj->ki", curve, step[at])
        bend = BEND / 2 * np.einsum("ki,kij,kj->k", step[at], spread, step[at])
        ahead[at] = (np.abs(left) + bend[:, None] * widest).max(axis=1) < tol
        ahead[open_[done]] = False
        best[ahead] -= step[ahead]
        fit.settled[ahead] = True
        open_ = open_[~done & ~ahead[open_]]
        trial[open_] = best[open_] - step[open_]
    return fit


def _terms(z: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, chance and its slope at scores ``z`` against labels ``t``, from one exponential that cannot overflow."""
    e = np.exp(-np.abs(z))
    less = 1.0 / (1.0 + e)
    p = np.where(z >= 0, less, e * less)
    return np.maximum(z, 0.0) - t * z + np.log1p(e), p, e * less * less


def one_vs_rest_path(df: DataFrame, key: str, features: list[str], label: str, classes: list[float], l2s: list[float], **options) -> DataFrame:
    """(l2, class, feature, weight) of every one-vs-rest member along a path of penalties; the bias is the feature ``bias``."""
    members = [Member(positive=c, l2=p) for p in l2s for c in classes]
    fit = stacked_logistic(df, key, features, label, members, **options)
    rows = [(b.l2, float(b.positive), name, float(w)) for b, ws in zip(members, fit.weights) for name, w in zip(["bias", *features], ws)]
    return df.sparkSession.createDataFrame(rows, "l2 double, class double, feature string, weight double")


def penalty_scores(df: DataFrame, key: str, features: list[str], label: str, fold: str, folds: int, l2s: list[float], **options) -> DataFrame:
    """(l2, fold, train, valid): accuracy of every penalty with every fold left out; two kinds of pass, all fits in each."""
    members = [Member(l2=p, fold=k) for p in l2s for k in range(folds)]
    fit = stacked_logistic(df, key, features, label, members, fold, **options)
    rows = df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("fold")).dropna()
    w, left = fit.weights, np.array([b.fold for b in members])

    def hits(batches):
        out = np.zeros((len(w), 4))
        for batch in batches:
            x_all, y_all, fold_all = _biased(matrix(batch.column(0))), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for s in range(0, len(x_all), ROWS):
                right = ((x_all[s : s + ROWS] @ w.T > 0) == (y_all[s : s + ROWS, None] == 1.0)).astype(np.float64)
                out_of = (fold_all[s : s + ROWS, None] == left).astype(np.float64)
                out += np.stack([((1 - out_of) * right).sum(0), (1 - out_of).sum(0), (out_of * right).sum(0), out_of.sum(0)], axis=1)
        return out.ravel()

    total = summed(rows, hits, len(w) * 4).reshape(-1, 4)
    table = [(b.l2, b.fold, float(t[0] / max(t[1], 1)), float(t[2] / max(t[3], 1))) for b, t in zip(members, total)]
    return df.sparkSession.createDataFrame(table, "l2 double, fold bigint, train double, valid double")


def balances(df: DataFrame, features: list[str], fit: StackedFit) -> DataFrame:
    """(l2, class, feature, balance): mean of feature x chance of the class, plus ``l2`` x weight.

    At a member's optimum this equals the mean of the feature over the class's rows as a
    share of all rows, which can be had without any fit.
    """
    w, names = fit.weights, ["bias", *features]

    def sums(batches):
        out, n = np.zeros((len(w), len(names))), 0
        for batch in batches:
            x_all = _biased(matrix(batch.column(0)))
            n += len(x_all)
            for s in range(0, len(x_all), ROWS):
                x = x_all[s : s + ROWS]
                out += _sigmoid(x @ w.T).T @ x
        return np.append(out.ravel(), n)

    total = summed(df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x")), sums, w.size + 1)
    mean = total[:-1].reshape(w.shape) / max(total[-1], 1) + np.array([b.l2 for b in fit.members])[:, None] * np.append(0.0, np.ones(len(features))) * w
    rows = [(b.l2, float(b.positive), name, float(v)) for b, vs in zip(fit.members, mean) for name, v in zip(names, vs)]
    return df.sparkSession.createDataFrame(rows, "l2 double, class double, feature string, balance double")
