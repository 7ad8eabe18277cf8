"""Adaptive boosting on a table of binned rows.

Rows are cut into bins once and counted per (bins, label).  Trees over bins, their errors and
the weights of the next round depend on these counts only, so a round re-weights the cells
of the table and needs no pass over the rows: hundreds of rounds cost what one costs.

The cells, at most the product of the bins times two, come to the driver like other
summaries; beyond ``max_cells`` the fit asks for fewer bins instead of going on.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALLEST_ERROR = 1e-10
MAX_CELLS = 2_000_000


def quantile_edges(df: DataFrame, features: list[str], bins: int, accuracy: float = 0.001) -> dict[str, list[float]]:
    """At most ``bins - 1`` edges per feature, at its quantiles; a value belongs to the first bin whose edge it does not exceed."""
    shares = [k / bins for k in range(1, bins)]
    found = df.select(*[F.col(c).cast("double").alias(c) for c in features]).approxQuantile(features, shares, accuracy)
    return {c: sorted(set(q)) for c, q in zip(features, found)}


def bin_codes(edges: dict[str, list[float]]) -> list[Column]:
    """The number of edges below each feature's value, as columns of bins."""
    out = []
    for c, cut in edges.items():
        codes = F.lit(0)
        for e in cut:
            codes = codes + (F.col(c) > F.lit(float(e))).cast("int")
        out.append(codes.alias(f"bin_{c}"))
    return out


@dataclass
class Node:
    """Rows with ``code[feature] <= bin`` go left; a leaf has a class."""

    label: int
    feature: int = -1
    bin: int = -1
    left: "Node | None" = None
    right: "Node | None" = None

    def predict(self, codes: np.ndarray) -> np.ndarray:
        if self.left is None:
            return np.full(len(codes), self.label)
        return np.where(codes[:, self.feature] <= self.bin, self.left.predict(codes), self.right.predict(codes))


def grow(codes: np.ndarray, weights: np.ndarray, sizes: list[int], depth: int | None) -> Node:
    """The tree of lowest weighted Gini index per split (first feature, then lowest bin on ties) over cells with weights per class."""
    total = weights.sum(axis=0)
    node = Node(int(total[1] > total[0]))
    if depth == 0 or (total == 0).any():
        return node
    best = None
    for f, size in enumerate(sizes):
        below = np.stack([np.bincount(codes[:, f], weights[:, k], size).cumsum() for k in (0, 1)])[:, :-1]
        above = total[:, None] - below
        n, m = below.sum(axis=0), above.sum(axis=0)
        seen = np.bincount(codes[:, f], minlength=size).cumsum()[:-1]
        with np.errstate(divide="ignore", invalid="ignore"):
            cost = n - (below**2).sum(axis=0) / n + m - (above**2).sum(axis=0) / m
        cost[(seen == 0) | (seen == len(codes))] = np.inf
        if len(cost) and np.isfinite(cost).any():
            at = int(np.argmin(cost))
            if best is None or cost[at] < best[0] - 1e-12 * total.sum():
                best = (cost[at], f, at)
    if best is None or best[0] >= total.sum() - (total**2).sum() / total.sum() - 1e-12 * total.sum():
        return node
    left = codes[:, best[1]] <= best[2]
    deeper = None if depth is None else depth - 1
    node.feature, node.bin = best[1], best[2]
    node.left, node.right = (grow(codes[side], weights[side], sizes, deeper) for side in (left, ~left))
    return node


@dataclass
class BinnedBoost:
    edges: dict[str, list[float]]
    trees: list[Node] = field(default_factory=list)
    alphas: list[float] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """The weighted vote of all rounds, in [-1, 1]."""
        total = np.zeros(len(codes))
        for tree, alpha in zip(self.trees, self.alphas):
            total += alpha * (2 * tree.predict(codes) - 1)
        return total / max(sum(map(abs, self.alphas)), SMALLEST_ERROR)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``score`` and ``prediction`` (0 or 1); rows with a NULL feature get NULL."""
        names = list(self.edges)

        def run(batches):
            for batch in batches:
                raw = np.stack([batch.column(batch.num_columns - len(names) + i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(names))], axis=1)
                known = ~np.isnan(raw).any(axis=1)
                score = np.full(len(raw), np.nan)
                if known.any():
                    distinct, back = np.unique(raw[known].astype(np.int64), axis=0, return_inverse=True)
                    score[known] = self.scores(distinct)[back.ravel()]
                guess = pa.array(np.where(known, score > 0, np.nan), pa.float64(), from_pandas=True)
                yield pa.RecordBatch.from_arrays([*batch.columns[: -len(names)], pa.array(score, from_pandas=True), guess], [*batch.schema.names[: -len(names)], "score", "prediction"])

        kept = df.drop("score", "prediction")
        return kept.select("*", *bin_codes(self.edges)).mapInArrow(run, kept.schema.add("score", "double").add("prediction", "double"))


def cells(df: DataFrame, edges: dict[str, list[float]], label: str, max_cells: int = MAX_CELLS) -> tuple[np.ndarray, np.ndarray]:
    """(bins, rows per class) of all distinct bins; rows with a NULL take no part."""
    known = df.dropna(subset=[*edges, label]).select(*bin_codes(edges), F.col(label).cast("int").alias("_y"))
    names = [f"bin_{c}" for c in edges]
    table = known.groupBy(*names).agg(F.count_if(F.col("_y") == 0).alias("n0"), F.count_if(F.col("_y") == 1).alias("n1"))
    got = table.limit(max_cells + 1).toArrow().sort_by([(c, "ascending") for c in names])
    if got.num_rows > max_cells:
        raise ValueError(f"more than {max_cells} cells: take fewer bins")
    columns = [got.column(c).to_numpy() for c in [*names, "n0", "n1"]]
    return np.stack(columns[:-2], axis=1).astype(np.int64), np.stack(columns[-2:], axis=1).astype(np.float64)


def adaboost_binned(df: DataFrame, edges: dict[str, list[float]], label: str, n_estimators: int, learning_rate: float = 1.0, max_depth: int | None = 1, max_cells: int = MAX_CELLS) -> BinnedBoost:
    """``n_estimators`` rounds of trees over bins (labels 0 and 1); stops early at an error of 0 or of one half."""
    model = BinnedBoost(edges)
    codes, counts = cells(df, edges, label, max_cells)
    if not len(codes):
        return model
    sizes = [len(e) + 1 for e in edges.values()]
    weights = counts / counts.sum()
    for _ in range(n_estimators):
        tree = grow(codes, weights, sizes, max_depth)
        guess = tree.predict(codes)
        wrong = np.stack([guess == 1, guess == 0], axis=1)
        error = float(weights[wrong].sum() / weights.sum())
        if error >= 0.5:
            break
        safe = max(error, SMALLEST_ERROR)
        alpha = learning_rate * 0.5 * math.log((1 - safe) / safe)
        model.trees.append(tree)
        model.alphas.append(alpha)
        model.errors.append(error)
        if error == 0.0:
            break
        weights = weights * np.where(wrong, math.exp(alpha), math.exp(-alpha))
        weights /= weights.sum()
    return model
