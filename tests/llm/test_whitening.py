"""Embedding whitening against dense linear algebra, exact sums against Python integers, and odd vectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from loomstat.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<double>, label int, component int, n long, x string, cell int"
FOLDER = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 7, 8, "x", None) for i, v in rows], SCHEMA)


def whole(v):
    """x as Python integers, stopped at 64 bits."""
    return tuple(max(-(2**63), min(2**63 - 1, math.floor(Fraction(c) * 256))) for c in v)


def remaining(rows, d):
    return [(i, whole(v)) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]


def check(spark, rows, d, count=4, close=1e-7):
    df = frame(spark, rows)
    found = whitening.whiten(df, whitening.fit(df, count=count), id_col="vec_id").collect()
    kept = remaining(rows, d)
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(x[j] for x in fit) for j in range(d)]
    scatter = [[n * sum(x[a] * x[b] for x in fit) - sums[a] * sums[b] for b in range(d)] for a in range(d)]
    values, vectors = np.linalg.eigh(np.array(scatter, float))
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    k, trace = min(count, d), sum(scatter[a][a] for a in range(d))
    assert len(found) == len(kept) * k and {r.n for r in found} <= {n}
    want = sorted((i is None, i or 0, sum((n * v - s) ** 2 for v, s in zip(x, sums))) for i, x in kept)
    assert sorted((r.vec_id is None, r.vec_id or 0, int(r.deviation) if r.deviation is not None else -1) for r in found if r.component == 1) == [
        (a, b, c if c < 10**38 else -1) for a, b, c in want
    ]
    gaps = [j for j in range(k) if all(abs(values[j] - values[o]) > 1e-6 * values[0] for o in range(d) if o != j)]
    for j in range(k):
        mine = {r.vec_id: r for r in found if r.component == j + 1}
        if trace:
            assert all(r.explained == pytest.approx(values[j] / trace, rel=1e-6, abs=1e-9) for r in mine.values())
        if j in gaps and values[j] > 1e-9 * values[0]:
            ideal = {i: float(np.dot([float(n * v - s) for v, s in zip(x, sums)], vectors[:, j])) / math.sqrt(values[j]) for i, x in kept}
            sign = np.sign(sum(ideal[i] * mine[i].whitened for i in ideal))
            assert all(abs(sign * ideal[i] - mine[i].whitened) < close * (1 + abs(ideal[i])) for i in ideal)
    return found


def test_query_equals_dense_algebra(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    found = queries.QUERIES["op12_embedding_whitening"](spark, FOLDER).collect()
    kept = dict(remaining(rows, 64))
    fit = np.array(sorted(set(kept.values())), float)
    n, centre = len(fit), fit.mean(0)
    cov = (fit - centre).T @ (fit - centre) / n
    values, vectors = np.linalg.eigh(cov)
    sums = [sum(int(x[j]) for x in set(kept.values())) for j in range(64)]
    assert len(found) == 4 * len(kept) and {r.n for r in found} == {n} and {r.identity_error for r in found} == {found[0].identity_error}
    assert found[0].identity_error <= 1e-4
    z = np.zeros((len(rows), 4))
    for r in found:
        assert r.deviation == sum((n * v - s) ** 2 for v, s in zip(kept[r.vec_id], sums))
        assert r.explained == pytest.approx(values[-r.component] / np.trace(cov), rel=1e-9)
        z[r.vec_id, r.component - 1] = r.whitened
    for c in range(4):
        ideal = (np.array([kept[i] for i in range(len(rows))]) - centre) @ vectors[:, -1 - c] / math.sqrt(values[-1 - c])
        assert min(np.abs(ideal - z[:, c]).max(), np.abs(ideal + z[:, c]).max()) < 1e-9


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)] + [(7, rng.normal(size=5).tolist()), (None, rng.normal(size=5).tolist())]
    rows += [(100 + i, rows[3][1]) for i in range(30)]  # repeated vectors count once
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [math.nan] * 5), (204, [1.0, math.inf, 0.0, 0.0, 0.0]), (205, [1.0, 2.0]), (206, [-0.0, 0.0, -1e-300, 1e-300, 0.5])]
    found = check(spark, [r for i, r in enumerate(rows) if r[0] != 7 or i == 7], 5)
    assert not {r.vec_id for r in found} & {200, 201, 202, 203, 204, 205}
    assert max(r.identity_error for r in found) < 1e-9


def test_very_large_entries_stay_exact(spark):
    rows = [(i, [float(v) for v in v3]) for i, v3 in enumerate([(1e300, 2.0, 3.0), (-1e300, 2.5, 1e10), (5e12, -7.0, 1.5e15), (1.0, 1e6, 2.0), (3.0, 2.0, 1.0)])]
    check(spark, rows, 3)


@pytest.mark.parametrize("rows,d", [([(1, [2.0, 3.0])], 2), ([(1, [2.0]), (2, [2.0])], 1), ([(1, [0.0, 1.0, 2.0]), (2, [0.0, 3.0, 2.0])], 3)])
def test_too_little_variance(spark, rows, d):
    found = check(spark, rows, d)
    flat = [r for r in found if not r.explained]
    assert all(r.whitened is None for r in flat) and len(flat) >= len(rows) * (d - 1)


def test_equal_variances_give_orthonormal_components(spark):
    rows = [(2 * i + s, [float((1 - 2 * s) * (j == i)) for j in range(5)]) for i in range(5) for s in (0, 1)]
    found = check(spark, rows, 5)
    assert {r.explained for r in found} == {0.2} and found[0].identity_error < 1e-12


def test_no_rows(spark):
    for rows in ([], [(1, None), (2, [])], [(1, [math.nan])]):
        df = frame(spark, rows)
        assert whitening.whiten(df, whitening.fit(df)).collect() == []


def test_polynomial_and_roots_are_exact():
    roots = [0, 0, 3, 3, 3, 10**12, 10**12 + 1, 10**15]
    poly = [1]
    for r in roots:
        poly = [(poly[k - 1] if k else 0) - r * (poly[k] if k < len(poly) else 0) for k in range(len(poly) + 1)]
    assert [whitening.roots_above(poly, a, 0) for a in (-1, 0, 2, 3, 10**12, 10**15)] == [8, 6, 6, 3, 2, 0]
    got = whitening.largest_roots(poly, 8)
    assert [round(r) for r, _ in got] == sorted(roots, reverse=True) and [g for _, g in got] == [0, 1, 2, 3, 3, 3, -1, -1]
    p = whitening.primes(1)[0]
    m = np.array([[2, 0, 0, 1], [0, 3, 0, 0], [0, 0, 4, 0], [1, 0, 0, 2]])
    assert whitening.polynomial_mod(m, p).tolist() == [c % p for c in np.round(np.poly(m))[::-1].astype(int).tolist()]
    assert all(all(q % f for f in range(2, 50000)) for q in whitening.primes(3))


def test_products_in_limbs():
    x = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, (7, 3), dtype=np.int64)
    want = [[sum(int(r[a]) * int(r[b]) for r in x) for b in range(3)] for a in range(3)]
    assert whitening.exact_products(x).tolist() == want
    assert whitening.exact_products(x >> 50).tolist() == [[sum(int(r[a]) * int(r[b]) for r in x >> 50) for b in range(3)] for a in range(3)]
