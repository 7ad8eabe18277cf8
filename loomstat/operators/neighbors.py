"""Nearest neighbours and distance sums, exact, in blocks of bounded size.

Rows meet in blocks inside tasks; a block pair returns its best few (or its
sums), never the distances themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstat.functions.hashing import seeded_hash

_CELLS_AT_ONCE = 4_000_000  # numbers held while one block of distances is worked out
_NARROW_AT_ONCE, _FEW = 1 << 17, 16  # distances held at once where rows are narrow; neighbours picked one by one
_PRODUCTS_AT_ONCE = 1 << 19  # distances held at once where they come from matrix products
_CLOSE = 1e-5  # squares below this share of both lengths are not taken from products


def as_array(df: DataFrame, cols: list[str], out: str = "vec") -> DataFrame:
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in cols]))


def _matrix(series: pd.Series) -> np.ndarray:
    return np.vstack(series.to_numpy()).astype("float64")


def _squared_distances(a: np.ndarray, b: np.ndarray):
    """Yield (start, squared distances of a[start:...] to b), a few rows at a time; narrow rows column by column, which adds up in the same order."""
    if 0 < a.shape[1] < 8:
        step, columns = max(1, _NARROW_AT_ONCE // max(1, len(b))), np.ascontiguousarray(b.T)
        for start in range(0, len(a), step):
            d2 = 0.0
            for x, y in zip(a[start : start + step].T, columns):
                gap = x[:, None] - y[None, :]
                gap *= gap
                d2 = np.add(d2, gap, out=gap)
            yield start, d2
        return
    step = max(1, _CELLS_AT_ONCE // max(1, b.size))
    for start in range(0, len(a), step):
        part = a[start : start + step]
        yield start, ((part[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)


def _home(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A centre near each row (the nearest but for rounding), and the distance to it."""
    if not (np.isfinite(centres).all() and np.isfinite(x).all()):
        cell = np.concatenate([d2.argmin(axis=1) for _, d2 in _squared_distances(x, centres)]).astype("int32")
        return cell, np.sqrt(((x - centres[cell]) ** 2).sum(axis=1))
    middle = centres.mean(axis=0)
    y = centres - middle
    low, flipped = (y * y).sum(axis=1), np.ascontiguousarray(-2.0 * y.T)
    step, cell = max(1, _NARROW_AT_ONCE // len(centres)), np.empty(len(x), dtype="int32")
    for start in range(0, len(x), step):
        d2 = (x[start : start + step] - middle) @ flipped
        d2 += low
        cell[start : start + step] = d2.argmin(axis=1)
    return cell, np.sqrt(((x - centres[cell]) ** 2).sum(axis=1))


def _smallest(d2: np.ndarray, take: int) -> np.ndarray:
    """Places of the ``take`` smallest entries of each row in order, the first on ties; ``d2`` is spoilt."""
    if take > _FEW or not np.isfinite(d2.sum()):
        return np.argsort(d2, axis=1, kind="stable")[:, :take]
    at, rows = np.empty((len(d2), take), dtype=np.intp), np.arange(len(d2))
    for j in range(take):
        if j:
            d2[rows, at[:, j - 1]] = np.inf
        at[:, j] = d2.argmin(axis=1)
    return at


def _literal(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)) for v in values])


def _slices(rows: DataFrame, key: str, own: Column, other: Column, own_name: str, other_name: str) -> DataFrame:
    """Deal rows to ``own`` slices and repeat each for all ``other`` slices."""
    dealt = rows.withColumn(own_name, F.pmod(F.xxhash64(key), own).cast("int"))
    return dealt.withColumn(other_name, F.explode(F.sequence(F.lit(0), other - 1)))


def nearest(train: DataFrame, queries: DataFrame, key: str, vec: str, label: str, k: int, pivots: int | None = None, block: int = 4096, seed: int = 0) -> DataFrame:
    """(query, neighbour, label, d2, rank): the ``k`` nearest training rows of each query.

    Some training rows (about the root of their number, 64 to 4096) serve as
    pivots and cut the space into cells.  The k-th
    nearest pivot bounds a query's search; a cell farther away than that bound
    cannot hold a neighbour and is not visited.  Cells with many rows or many
    visits are sliced, so no task gets more than ``block`` rows of either side on
    average.  Ties go to the smaller neighbour key.
    """
    if pivots is None:
        pivots = min(4096, max(64, math.isqrt(train.count())))
    chosen = train.select(vec, key).orderBy(seeded_hash(seed, key), key).limit(max(pivots, k)).collect()
    centres = np.array([row[vec] for row in chosen], dtype="float64")

    @F.pandas_udf("cell int, d double")
    def home(v: pd.Series) -> pd.DataFrame:
        cell, dist = _home(_matrix(v), centres)
        return pd.DataFrame({"cell": cell, "d": dist})

    housed = train.select(F.col(key).alias("neighbour"), F.col(vec).alias("tvec"), F.col(label).alias("label"), home(vec).alias("h"))
    sizes = {r["cell"]: (r["n"], r["far"]) for r in housed.groupBy("h.cell").agg(F.count(F.lit(1)).alias("n"), F.max("h.d").alias("far")).collect()}
    counts = [sizes.get(c, (0, 0.0))[0] for c in range(len(centres))]
    far = np.array([sizes.get(c, (0, 0.0))[1] for c in range(len(centres))])
    occupied = np.array(counts) > 0

    @F.pandas_udf("array<int>")
    def visits(v: pd.Series) -> pd.Series:
        out = []
        for _, d2 in _squared_distances(_matrix(v), centres):
            d = np.sqrt(d2)
            bound = d.min(axis=1, keepdims=True) if k == 1 and np.isfinite(d.sum()) else np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1 : min(k, d.shape[1])]
            near = (d - far <= bound * (1 + 1e-9) + 1e-9) & occupied
            out.extend(np.flatnonzero(row).astype("int32") for row in near)
        return pd.Series(out)

    asked = queries.select(F.col(key).alias("query"), F.col(vec).alias("qvec"), F.explode(visits(vec)).alias("cell"))
    visited = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    train_slices = [max(1, math.ceil(n / block)) for n in counts]
    query_slices = [max(1, math.ceil(visited.get(c, 0) / block)) for c in range(len(centres))]
    ts, qs = (F.element_at(_literal(x), F.col("cell") + 1) for x in (train_slices, query_slices))

    left = _slices(asked, "query", qs, ts, "q_slice", "t_slice")
    right = _slices(housed.select("neighbour", "tvec", "label", F.col("h.cell").alias("cell")), "neighbour", ts, qs, "t_slice", "q_slice")
    label_type = train.schema[label].dataType.simpleString()
    q_type, n_type = queries.schema[key].dataType.simpleString(), train.schema[key].dataType.simpleString()
    schema = f"query {q_type}, neighbour {n_type}, label {label_type}, d2 double"

    def best(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        if q.empty or t.empty:
            return pd.DataFrame({"query": [], "neighbour": [], "label": [], "d2": []})
        t = t.sort_values("neighbour", kind="stable").reset_index(drop=True)
        a, b = _matrix(q["qvec"]), _matrix(t["tvec"])
        take = min(k, len(t))
        found = []
        for start, d2 in _squared_distances(a, b):
            held = d2.copy() if 1 < take <= _FEW else d2
            at = _smallest(held, take)
            rows = np.repeat(np.arange(start, start + len(d2)), take)
            found.append((rows, at.ravel(), np.take_along_axis(d2, at, axis=1).ravel()))
        rows, at, d2 = (np.concatenate([f[i] for f in found]) for i in range(3))
        return pd.DataFrame(
            {"query": q["query"].to_numpy()[rows], "neighbour": t["neighbour"].to_numpy()[at], "label": t["label"].to_numpy()[at], "d2": d2}
        )

    by = ["cell", "t_slice", "q_slice"]
    candidates = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(best, schema)
    order = Window.partitionBy("query").orderBy("d2", "neighbour")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def neighbour_shares(neighbours: DataFrame, classes: list) -> DataFrame:
    """(query, p_0, p_1, ..., prediction): share of each class, in the given order, among the neighbours."""
    shares = neighbours.groupBy("query").agg(*[F.avg((F.col("label") == c).cast("double")).alias(f"p_{i}") for i, c in enumerate(classes)])
    values = F.array(*[F.col(f"p_{i}") for i in range(len(classes))])
    at = F.array_position(values, F.array_max(values)).cast("int")
    return shares.withColumn("prediction", F.element_at(F.array(*[F.lit(c) for c in classes]), at))


def _block_count(rows: DataFrame, block: int) -> int:
    """Blocks of at most ``block`` rows on average, and some pairs of blocks for every core."""
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(n / block), min(math.ceil(math.sqrt(3 * cores)), math.ceil(n / 128)))


def _paired(rows: DataFrame, key: str, block: int):
    blocks = F.lit(_block_count(rows, block))
    left = _slices(rows, key, blocks, blocks, "b1", "b2")
    right = _slices(rows, key, blocks, blocks, "b2", "b1")
    return left.groupBy("b1", "b2").cogroup(right.groupBy("b1", "b2"))


def blockwise(rows: DataFrame, key: str, fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, block: int = 4096) -> DataFrame:
    """Apply ``fn`` to every pair of row blocks; ``fn`` must reduce what it sees.

    The work is the square of the rows by nature; shuffled are the rows times the
    number of blocks.
    """
    return _paired(rows, key, block).applyInPandas(fn, schema)


def blockwise_arrow(rows: DataFrame, key: str, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str, block: int = 16384) -> DataFrame:
    """As ``blockwise`` on Arrow tables: a block may hold more rows, as they are no Python objects."""
    return _paired(rows, key, block).applyInArrow(fn, schema)


def _distances(a: np.ndarray, b: np.ndarray):
    """Yield (start, distances of a[start:...] to b), a few rows at a time.

    Squares come from one matrix product about the middle of ``b``; where they are so small
    that the product's rounding would show, they are worked out entry by entry.
    """
    finite = np.isfinite(b).all(axis=1)  # distances to and from other rows are worked out entry by entry
    middle = b[finite].mean(axis=0) if finite.any() else 0.0
    x, y = a - middle, b - middle
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    flipped = np.ascontiguousarray(-2.0 * y.T)
    step = max(1, _PRODUCTS_AT_ONCE // len(b))
    for start in range(0, len(a), step):
        part = slice(start, start + step)
        with np.errstate(invalid="ignore"):
            d2 = x[part] @ flipped
            both = xx[part, None] + yy
            d2 += both
            both *= _CLOSE
            at = np.flatnonzero((~(d2 > both)).ravel())
        for s in range(0, len(at), _PRODUCTS_AT_ONCE // 16):
            some = at[s : s + _PRODUCTS_AT_ONCE // 16]
            i, j = np.divmod(some, len(b))
            d2[i, j] = ((a[start + i] - b[j]) ** 2).sum(axis=1)
        yield start, np.sqrt(d2, out=d2)


def _vectors(table: pa.Table, vec: str) -> np.ndarray:
    column = table.column(vec).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False).reshape(len(table), -1)


def _is_equal(one: pa.Array, two: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the values of two arrays, equal where the values are."""
    codes = pa.chunked_array([one, two]).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return codes[: len(one)], codes[len(one) :]


def distance_sums(rows: DataFrame, key: str, vec: str, group: str, block: int = 16384) -> DataFrame:
    """(key, other, total, n): distances from each row to all rows of each group, summed."""
    kt, gt = (rows.schema[c].dataType.simpleString() for c in (key, group))

    def sums(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.table([a.column(key).slice(0, 0), b.column(group).slice(0, 0), pa.array([], pa.float64()), pa.array([], pa.int64())], names)
        coded = b.column(group).combine_chunks().dictionary_encode(null_encoding="encode")
        member = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(member, kind="stable")
        starts = np.searchsorted(member[order], np.arange(len(coded.dictionary)))
        x, y = _vectors(a, vec), _vectors(b, vec)[order]
        total = np.concatenate([np.add.reduceat(d, starts, axis=1) for _, d in _distances(x, y)])
        at = np.repeat(np.arange(len(a)), len(starts))
        others = coded.dictionary.take(pa.array(np.tile(np.arange(len(starts)), len(a))))
        return pa.table([a.column(key).combine_chunks().take(pa.array(at)), others, total.ravel(), np.tile(np.bincount(member), len(a))], names)

    names = [key, "other", "total", "n"]
    parts = blockwise_arrow(rows.select(key, vec, group), key, sums, f"{key} {kt}, other {gt}, total double, n bigint", block)
    return parts.groupBy(key, "other").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def distance_summary(rows: DataFrame, key: str, vec: str, block: int = 16384) -> DataFrame:
    """(key, nearest, mean, farthest): distances from each row to all other rows."""
    kt = rows.schema[key].dataType.simpleString()
    names = [key, "low", "total", "high", "n"]

    def reduce(a: pa.Table, b: pa.Table) -> pa.Table:
        keys = a.column(key).combine_chunks()
        if not len(a) or not len(b):
            return pa.table([keys.slice(0, 0), *[pa.array([], t) for t in (pa.float64(), pa.float64(), pa.float64(), pa.int64())]], names)
        mine, theirs = _is_equal(keys, b.column(key).combine_chunks())
        order = np.argsort(theirs, kind="stable")
        first, last = (np.searchsorted(theirs[order], mine, side=side) for side in ("left", "right"))
        y = _vectors(b, vec)[order]
        out = []
        for start, d in _distances(_vectors(a, vec), y):
            total = d.sum(axis=1)
            same = [(i, slice(first[start + i], last[start + i])) for i in range(len(d)) if first[start + i] < last[start + i]]
            for i, at in same:  # rows of the same key are no others
                total[i] = d[i, : at.start].sum() + d[i, at.stop :].sum()
                d[i, at] = np.inf
            low = d.min(axis=1)
            for i, at in same:
                d[i, at] = -np.inf
            out.append(np.column_stack([low, total, d.max(axis=1)]))
        low, total, high = np.concatenate(out).T
        n = len(y) - (last - first)
        some = np.flatnonzero(n > 0)
        return pa.table([keys.take(pa.array(some)), low[some], total[some], high[some], n[some]], names)

    parts = blockwise_arrow(rows.select(key, vec), key, reduce, f"{key} {kt}, low double, total double, high double, n bigint", block)
    return parts.groupBy(key).agg(
        F.min("low").alias("nearest"), (F.sum("total") / F.sum("n")).alias("mean"), F.max("high").alias("farthest")
    )
