"""Boosting on binned counts against rounds over single rows."""

import math

import numpy as np
import pytest

from loomstat.operators import boosting

EDGES = {"a": [-1.0, 0.0, 1.0], "b": [0.5], "c": []}


def made(spark, n=400):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(n, 3)), 2)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5) ^ (rng.random(n) < 0.15)).astype(int)
    return x, y, spark.createDataFrame([(*map(float, v), int(t), "s") for v, t in zip(x, y)], "a double, b double, c double, label int, score string")


def plain(x, y, rounds, rate):
    """(feature, error, alpha) per round of stumps, over rows."""
    w, out = np.full(len(y), 1 / len(y)), []
    for _ in range(rounds):
        best = None
        for f, (_, edges) in enumerate(EDGES.items()):
            for e in edges:
                low = x[:, f] <= e
                sides = [(w[s & (y == 0)].sum(), w[s & (y == 1)].sum()) for s in (low, ~low)]
                cost = sum(p + q - (p * p + q * q) / (p + q) for p, q in sides)
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, f, low, sides)
        _, f, low, sides = best
        guess = np.where(low, sides[0][1] > sides[0][0], sides[1][1] > sides[1][0]).astype(int)
        error = w[guess != y].sum()
        alpha = rate * 0.5 * math.log((1 - error) / error)
        out.append((f, error, alpha))
        w = w * np.exp(np.where(guess != y, alpha, -alpha))
        w /= w.sum()
    return out


def test_rounds_equal_rounds_over_rows(spark):
    x, y, df = made(spark)
    model = boosting.adaboost_binned(df, EDGES, "label", 30, 0.3)
    want = plain(x, y, 30, 0.3)
    assert [t.feature for t in model.trees] == [f for f, _, _ in want]
    assert model.errors == pytest.approx([e for _, e, _ in want]) and model.alphas == pytest.approx([a for _, _, a in want])


def test_deeper_trees_and_scores(spark):
    x, y, df = made(spark)
    model = boosting.adaboost_binned(df, EDGES, "label", 20, 0.5, max_depth=2)
    out = model.transform(df).collect()
    assert np.mean([r.prediction == r.label for r in out]) > 0.8 and all(-1 <= r.score <= 1 for r in out)
    assert len(boosting.adaboost_binned(df, EDGES, "label", 5, max_depth=None).trees) >= 1
    odd = spark.createDataFrame([(None, 1.0, 1.0, 1, "s"), (1.0, 1.0, 1.0, 1, None)], df.schema)
    got = model.transform(odd).orderBy("a").collect()
    assert got[0].score is None and got[0].prediction is None and got[1].prediction in (0.0, 1.0)


def test_edges_of_the_fit(spark):
    _, _, df = made(spark)
    one = boosting.adaboost_binned(df.where("label = 1"), EDGES, "label", 5)
    assert one.errors == [0.0] and {r.prediction for r in one.transform(df).collect()} == {1.0}
    empty = boosting.adaboost_binned(df.limit(0), EDGES, "label", 5)
    assert empty.trees == [] and {r.prediction for r in empty.transform(df).collect()} == {0.0}
    with pytest.raises(ValueError):
        boosting.adaboost_binned(df, EDGES, "label", 5, max_cells=3)
    cuts = boosting.quantile_edges(df, ["a", "b"], 8)
    assert all(len(c) <= 7 and c == sorted(set(c)) for c in cuts.values())
