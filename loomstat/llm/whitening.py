"""Embedding whitening by exact integer scatter and its characteristic polynomial.

Entries become whole numbers x = floor(256 c); those beyond 64 bits stop at its ends.  The
fit list holds each distinct x once (n vectors, sums S).  All sums over it are exact, so
the scatter M = n sum(x x') - S S' is an integer matrix whose eigenvalues are n^2 times
the variances.  Its characteristic polynomial is worked out modulo many primes by reduction
to Hessenberg form, primes dealt over the cluster, and put together by Chinese remainders.
As all its roots are real, the sign changes of the polynomial shifted to a point count the
roots above it exactly: bisection on them isolates the largest roots and goes on to
``PRECISION`` bits.  Inverse iteration on M - root, in ``DIGITS`` decimal digits, gives the
components; a root of multiplicity m gives m orthonormal ones.

Left out are rows whose vector is NULL, empty, of another length than the most frequent
one (the longer of two equally frequent), or holds NULL or non-finite entries.  Repeated
vectors count once in the fit; repeated rows and NULL ids are kept.  Components without
variance have explained 0 and NULL whitened values; where nothing varies, explained and
identity_error are NULL.  Deviations of more than 38 digits are NULL.  Other columns are not
read; an empty table gives an empty result.

Only sums (d x d numbers) and d + 1 coefficients per prime reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.operators.batches import summed
from loomstat.session import cut_lineage

SCALE, COMPONENTS = 256, 4
PRECISION, DIGITS, TURNS = 200, 140, 4
PRIME_BELOW = 1 << 31
LIMB, WORD = 16, 31
SAFE = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` learns: counts and sums of the fit list, unit components as columns, their roots of M."""

    n: int
    sums: list[int]
    trace: int
    roots: list[Fraction]
    vectors: np.ndarray
    error: float | None

    @property
    def matrix(self) -> np.ndarray:
        """What (n x - S) is multiplied with: components over the roots' square roots, those without variance left out."""
        with localcontext() as ctx:
            ctx.prec = 50
            size = [float((Decimal(r.numerator) / Decimal(r.denominator)).sqrt()) for r in self.roots if r > 0]
        return self.vectors[:, : len(size)] / np.array(size)


# ---- vectors in batches ---------------------------------------------------


def integers(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the rows that remain, their x as 64-bit integers) of a list column."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    rows = np.flatnonzero(sizes == d)
    c = values[starts[rows][:, None] + np.arange(d)] if len(rows) < len(sizes) else values.reshape(-1, d)
    fine = np.isfinite(c).all(1)
    with np.errstate(over="ignore"):
        x = np.floor(c[fine] * SCALE)
    low, high = x <= -(2.0**63), x >= 2.0**63
    x = np.where(low | high, 0, x).astype(np.int64)
    return rows[fine], np.where(high, np.iinfo(np.int64).max, np.where(low, np.iinfo(np.int64).min, x))


def _packed(x: np.ndarray):
    """Binary columns with the rows of ``x``, each in the fewest bytes an entry that hold it."""
    need = np.full(len(x), 8)
    for width in (4, 2, 1):
        info = np.iinfo(f"i{width}")
        need[(x.min(1) >= info.min) & (x.max(1) <= info.max)] = width
    for width in np.unique(need):
        part = np.ascontiguousarray(x[need == width].astype(f"<i{width}"))
        ends = np.arange(len(part) + 1, dtype=np.int32) * (part.shape[1] * int(width))
        yield pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(ends), pa.py_buffer(part)])


def _unpacked(column: pa.Array, d: int):
    """The matrices held in a column of ``_packed`` rows."""
    width = pc.binary_length(column).to_numpy(zero_copy_only=False) // d
    for w in np.unique(width):
        raw = b"".join(column.filter(pa.array(width == w)).to_pylist())
        yield np.frombuffer(raw, f"<i{w}").reshape(-1, d).astype(np.int64)


def largest(x: np.ndarray) -> int:
    """The largest absolute value, exact."""
    return max(int(x.max()), -int(x.min())) if x.size else 0


def exact_products(x: np.ndarray) -> np.ndarray:
    """x' x as Python integers: float products of limbs so small that no sum is rounded."""
    if len(x) * largest(x) ** 2 < 1 << 53:
        y = x.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    if len(x) > 1 << 20:
        return exact_products(x[: 1 << 20]) + exact_products(x[1 << 20 :])
    limbs = [((x >> (LIMB * k)) & 0xFFFF if k < 3 else x >> (LIMB * k)).astype(np.float64) for k in range(4)]
    total = np.zeros((x.shape[1],) * 2, object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return total


def _exact_sums(x: np.ndarray) -> np.ndarray:
    if len(x) * largest(x) < SAFE:
        return x.sum(0).astype(object)
    return ((x >> 32).sum(0).astype(object) << 32) + (x & 0xFFFFFFFF).sum(0).astype(object)


def moments(distinct: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, S, sum of x x') over packed rows, exact: tasks send their totals in digits of ``WORD`` bits."""
    i, j = np.triu_indices(d)

    def task(batches):
        n, sums, products = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            for x in _unpacked(batch.column(0), d):
                n, sums, products = n + len(x), sums + _exact_sums(x), products + exact_products(x)
        at, digits = [], []
        for cell, value in enumerate([n, *sums, *products[i, j]]):
            sign, value, word = (-1 if value < 0 else 1), abs(int(value)), 0
            while value:
                at.append((cell, word))
                digits.append(sign * (value & (1 << WORD) - 1))
                value, word = value >> WORD, word + 1
        if at:
            cells, words = zip(*at)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(words, pa.int64()), pa.array(digits, pa.int64())], ["cell", "word", "v"])

    total = np.zeros(1 + d + len(i), object)
    for r in distinct.mapInArrow(task, "cell long, word long, v long").groupBy("cell", "word").agg(F.sum("v").alias("v")).collect():
        total[r["cell"]] += r["v"] << (WORD * r["word"])
    products = np.zeros((d, d), object)
    products[i, j] = products[j, i] = total[1 + d :]
    return int(total[0]), total[1 : 1 + d], products


# ---- the characteristic polynomial ----------------------------------------


def primes(count: int) -> list[int]:
    """The largest primes below 2^31."""
    odd, found, p = np.arange(3, 46342, 2), [], PRIME_BELOW - 1
    while len(found) < count:
        if np.all(p % odd):
            found.append(p)
        p -= 2
    return found


def polynomial_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x I - m) modulo p, lowest first: Hessenberg form by similarity, then its recurrence."""
    d, h = len(m), m % p
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        h[[k, k + below[0]]] = h[[k + below[0], k]]
        h[:, [k, k + below[0]]] = h[:, [k + below[0], k]]
        f = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - f[:, None] * h[k]) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * f % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        last = polys[k - 1]
        polys[k] = (np.append(0, last[:-1]) - h[k - 1, k - 1] * last) % p
        below, scale = 1, np.zeros(k - 1, np.int64)
        for i in range(k - 2, -1, -1):
            below = below * int(h[i + 1, i]) % p
            scale[i] = below * int(h[i, k - 1]) % p
        polys[k] = (polys[k] - (scale[:, None] * polys[: k - 1] % p).sum(0)) % p
    return polys[d]


def characteristic(spark: SparkSession, m: np.ndarray) -> list[int]:
    """Coefficients of det(x I - m), lowest first, of a symmetric integer matrix without negative eigenvalues.

    No coefficient exceeds C(d, k) (trace / d)^k, which says how many primes are needed.
    """
    d, trace = len(m), int(np.trace(m))
    bound = max(comb(d, k) * (trace**k // d**k + 1) for k in range(d + 1))
    moduli = primes(2 * bound.bit_length() // 61 + 2)

    def run(batches):
        for batch in batches:
            for p in batch.column(0).to_pylist():
                got = polynomial_mod((m % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([got.tolist()])], ["p", "c"])

    rows = spark.createDataFrame([(p,) for p in moduli], "p long").mapInArrow(run, "p long, c array<long>").collect()
    whole = 1
    for r in rows:
        whole *= r["p"]
    parts = [(whole // r["p"]) * pow(whole // r["p"], -1, r["p"]) for r in rows]
    out = [sum(r["c"][k] * part for r, part in zip(rows, parts)) % whole for k in range(d + 1)]
    return [c - whole if 2 * c > whole else c for c in out]


def roots_above(poly: list[int], a: int, s: int) -> int:
    """How many roots, with multiplicity, of a polynomial with real roots only lie above a / 2^s."""
    d = len(poly) - 1
    c = [v << (s * (d - k)) for k, v in enumerate(poly)]
    for i in range(d):  # Taylor shift by repeated synthetic division
        for k in range(d - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _value_sign(poly: list[int], a: int, s: int) -> int:
    total = 0
    for k, v in enumerate(reversed(poly)):
        total = total * a + (v << (s * k))
    return (total > 0) - (total < 0)


def largest_roots(poly: list[int], count: int) -> list[tuple[Fraction, int]]:
    """(root, group) of the largest ``count`` roots, falling: roots that no bisection step tells apart share a group."""
    zeros = next(k for k, v in enumerate(poly) if v)
    poly = poly[zeros:]  # roots at zero are known
    d = len(poly) - 1
    top = 1 << (max(-poly[d - 1], 1).bit_length() + 1) if d else 1
    out: list[tuple[Fraction, int]] = []
    while len(out) < min(count, d):
        k = len(out) + 1  # the interval (lo, hi] / 2^s holds the k-th root
        lo, hi, s, above, below = 0, top, 0, d, 0
        while lo == 0 or (hi - lo) << PRECISION > lo:
            if hi - lo == 1:
                lo, hi, s = 2 * lo, 2 * hi, s + 1
            mid = (lo + hi) // 2
            if above - below == 1:  # one root: the sign tells its side
                at_hi = _value_sign(poly, hi, s)
                sign = _value_sign(poly, mid, s)
                n = below if at_hi and (sign == 0 or sign == at_hi) else above if at_hi else roots_above(poly, mid, s)
            else:
                n = roots_above(poly, mid, s)
            if n >= k:
                lo, above = mid, n
            else:
                hi, below = mid, n
        root = Fraction(lo + hi, 2 << s)
        out += [(root, len(out))] * (above - below)
    return (out + [(Fraction(0), -1)] * zeros)[:count]


# ---- components -----------------------------------------------------------


def _solver(m: np.ndarray, root: Fraction):
    """A function that solves (m - root) y = b by elimination in decimal numbers, rows exchanged for the largest pivot."""
    d = len(m)
    a = np.array([[Decimal(int(v)) for v in row] for row in m], object)
    a[np.arange(d), np.arange(d)] -= Decimal(root.numerator) / Decimal(root.denominator)
    order = np.arange(d)
    least = max(abs(v) for v in a.ravel()) * Decimal(10) ** (5 - DIGITS) or Decimal(1)
    for k in range(d):
        best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        a[[k, best]], order[[k, best]] = a[[best, k]], order[[best, k]]
        if abs(a[k, k]) < least:
            a[k, k] = least
        a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])

    def solve(b):
        y = b[order].copy()
        for k in range(d):
            y[k + 1 :] -= a[k + 1 :, k] * y[k]
        for k in range(d - 1, -1, -1):
            y[k] = y[k] / a[k, k]
            y[:k] -= a[:k, k] * y[k]
        return y

    return solve


def _unit(y: np.ndarray) -> np.ndarray:
    return y / (y * y).sum().sqrt()


def components(m: np.ndarray, roots: list[tuple[Fraction, int]]) -> np.ndarray:
    """Unit eigenvectors as columns, to double precision; those of one group are orthogonal to each other."""
    d, found, groups = len(m), [], []
    rng = np.random.default_rng(12)
    with localcontext() as ctx:
        ctx.prec = DIGITS
        solve = None
        for i, (root, group) in enumerate(roots):
            if solve is None or group != roots[i - 1][1]:
                solve = _solver(m, root)
            before = [v for v, g in zip(found, groups) if g == group]
            y = _unit(np.array([Decimal(int(v)) for v in rng.integers(1, 1000, d)], object))
            for _ in range(TURNS):
                y = _unit(solve(y))
                for v in before * 2:
                    y = y - (v * y).sum() * v
                y = _unit(y)
            found.append(y)
            groups.append(group)
    return np.array([[float(v) for v in y] for y in found]).reshape(-1, d).T


# ---- fit and use ----------------------------------------------------------


def _named(df: DataFrame, id_col, vector_col) -> DataFrame:
    return df.select(df[id_col].cast("bigint").alias("vec_id"), df[vector_col].cast("array<double>").alias("v"))


def width(df: DataFrame, vector_col="embedding") -> int:
    """The most frequent length of a vector, 0 if there is none."""
    sizes = df.where(F.size(df[vector_col]) > 0).groupBy(F.size(df[vector_col]).alias("d")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S as doubles, exact up to the one rounding."""
    if n * largest(x) + max(map(abs, sums)) < SAFE:
        return (n * x - np.array(sums, np.int64)).astype(np.float64)
    return (n * x.astype(object) - np.array(sums, object)).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """sum of (n x - S)^2 of each row, exact: as 64-bit or as Python integers."""
    top, far, d = largest(x), max(map(abs, sums)), x.shape[1]
    if d * (n * top + far) ** 2 < SAFE:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(1)
    wide = x if d * top * max(top, far) < SAFE else x.astype(object)
    squares, along = (wide * wide).sum(1), wide.dot(np.array(sums, wide.dtype))
    return n * n * squares.astype(object) - 2 * n * along.astype(object) + sum(s * s for s in sums)


def fit(df: DataFrame, id_col="vec_id", vector_col="embedding", count: int = COMPONENTS) -> Whitening | None:
    """Count, sums and the first ``count`` components of the distinct vectors; None without any."""
    d = width(df, vector_col)
    if not d:
        return None

    def pack(batches):
        for batch in batches:
            x = integers(batch.column(1), d)[1]
            for column in _packed(x) if len(x) else ():
                yield pa.RecordBatch.from_arrays([column], ["x"])

    distinct = cut_lineage(_named(df, id_col, vector_col).mapInArrow(pack, "x binary").distinct())
    n, sums, products = moments(distinct, d)
    if not n:
        return None
    scatter = n * products - np.outer(sums, sums)
    poly = characteristic(df.sparkSession, scatter)
    roots = largest_roots(poly, min(count, d))
    model = Whitening(n, [int(s) for s in sums], int(np.trace(scatter)), [r for r, _ in roots], components(scatter, roots), None)
    by, k = model.matrix, sum(r > 0 for r, _ in roots)
    if not k:
        return model

    def squares(batches):
        total = np.zeros(k + k * k)
        for batch in batches:
            for x in _unpacked(batch.column(0), d):
                z = centred(x, n, model.sums) @ by
                total += np.concatenate([z.sum(0), (z.T @ z).ravel()])
        return total

    total = summed(distinct, squares, k + k * k) / n
    error = np.abs(total[k:].reshape(k, k) - np.outer(total[:k], total[:k]) - np.eye(k)).max()
    return Whitening(n, model.sums, model.trace, model.roots, model.vectors, float(error))


def whiten(df: DataFrame, model: Whitening | None, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """Per remaining row and component: its number, n, the exact deviation, the whitened value, the share of variance and the identity error."""
    names = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.float64(), pa.float64(), pa.float64()]
    if model is None:
        return df.sparkSession.createDataFrame([], names)
    d, k, by = len(model.sums), len(model.roots), model.matrix
    shares = [float(r / model.trace) if model.trace else None for r in model.roots]

    def run(batches):
        for batch in batches:
            rows, x = integers(batch.column(1), d)
            if not len(rows):
                continue
            dev = deviations(x, model.n, model.sums)
            if dev.dtype == object:
                dev = pa.array([Decimal(v) if v < 10**38 else None for v in dev.tolist()], pa.decimal128(38, 0))
            else:
                dev = pa.array(dev).cast(pa.decimal128(38, 0))
            z = np.full((len(rows), k), np.nan)
            z[:, : by.shape[1]] = centred(x, model.n, model.sums) @ by
            each = np.repeat(np.arange(len(rows)), k)
            columns = [
                batch.column(0).take(pa.array(rows[each])),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(each), model.n)),
                dev.take(pa.array(each)),
                pa.array(z.ravel(), from_pandas=True),
                pa.array(shares * len(rows), pa.float64()),
                pa.array([model.error] * len(each), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, kinds)], [part.split()[0] for part in names.split(", ")])

    return _named(df, id_col, vector_col).mapInArrow(run, names)
