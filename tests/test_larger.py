"""Work that grew too fast: the same results in bounded space."""

from hashlib import md5

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from loomstat.functions import text as tx
from loomstat.operators import classify, cluster, joins, linkage, neighbors, sampling, stacked, vectorize, wide
from loomstat.plans import learners, pairs, tabular
from loomstat.plans import text as text_plans


def test_merge_tree_without_a_table_of_all_pairs(spark, monkeypatch):
    x = np.random.default_rng(5).integers(0, 9, (120, 2)).astype(float)  # many ties and copies
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(500, None)], "id bigint, vec array<double>")
    want = sorted((m.a, m.b, m.distance) for m in linkage.complete_linkage(linkage.pair_distances(items, "id", "vec")).collect())
    for few, block in ((30, 50), (500, 8192)):
        monkeypatch.setattr(linkage, "_BLOCK", block)
        assert sorted((m.a, m.b, m.distance) for m in linkage.point_linkage(items, "id", "vec", few=few).collect()) == want
    monkeypatch.setattr(linkage, "pair_distances", lambda *_, **__: pytest.fail("a table of all pairs"))
    assert linkage.merge_tree(items, "id", "vec").count() == 119
    assert linkage.point_linkage(items.limit(0), "id", "vec").count() == 0


def test_cells_add_up_as_single_points_do(spark, monkeypatch):
    rng = np.random.default_rng(9)
    for width, k, n in ((2, 7, 5000), (1, 3, 400), (6, 4, 900)):
        x = np.concatenate([rng.normal(size=(n, width)), np.repeat(rng.normal(size=(3, width)), 60, axis=0)]).round(2)
        batch, centres = cluster._pack(x), x[rng.integers(0, n, k)] + 0.001
        cells = cluster._Cells(batch.column(0)[0].values.to_numpy().reshape(width, -1), batch.column(1)[0].values.to_numpy())
        got = np.zeros((k, width + 2))
        cells.add(centres, got)
        d2 = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        near = d2.argmin(axis=1)
        for c in range(k):
            own = x[near == c]
            assert got[c] == pytest.approx([len(own), d2[near == c, c].sum(), *own.sum(axis=0)], abs=1e-7)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 2)))], "id long, vec array<double>")
    monkeypatch.setattr(cluster, "_PACK", 64)
    packs = cluster._packed(rows.select("vec")).collect()
    assert sum(sum(p.sizes) for p in packs) == 300 and max(len(p.points) for p in packs) < 600


@pytest.mark.parametrize("block", [40, 16384])
def test_distances_from_products_equal_single_ones(spark, block):
    rng = np.random.default_rng(2)
    x = 1000 + rng.normal(size=(150, 8))
    x[50:90] = x[10:50]  # copies
    x[90:100] = x[0:10] + 1e-4 * rng.normal(size=(10, 8))  # near copies, far from the origin
    label = rng.integers(0, 3, 150)
    rows = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))], "id long, vec array<double>, cluster long")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.nan)
    got = {r.id: (r.nearest, r.mean, r.farthest) for r in neighbors.distance_summary(rows, "id", "vec", block).collect()}
    for i in range(150):
        assert got[i] == pytest.approx((np.nanmin(d[i]), np.nanmean(d[i]), np.nanmax(d[i])), abs=1e-9)
    sums = {(r.id, r.other): (r.total, r.n) for r in neighbors.distance_sums(rows, "id", "vec", "cluster", block).collect()}
    for i in range(150):
        for c in range(3):
            assert sums[i, c] == pytest.approx((np.nansum(d[i, label == c]), (label == c).sum()), abs=1e-8)


def test_distances_by_products_are_taken(monkeypatch):
    """No block of entries (rows x rows x width) where vectors differ."""
    monkeypatch.setattr(neighbors, "_squared_distances", lambda *_: pytest.fail("entry by entry"))
    a, b = np.random.default_rng(1).normal(size=(2, 30, 5))
    b[3, 0], a[4, 1], b[5, 2] = np.inf, np.nan, -np.inf
    with np.errstate(invalid="ignore"):
        want = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
        np.testing.assert_allclose(np.concatenate([d for _, d in neighbors._distances(a, b)]), want, rtol=1e-9)


def test_parts_of_texts_stay_small(spark, monkeypatch):
    """More text makes more parts, not larger ones; counts of repeated and NULL keys are still taken together."""
    rows = [(i % 90 if i % 50 else None, "a b a " + " ".join(f"w{j}" for j in range(i % 40))) for i in range(400)] + [(3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = F.split("text", " ")
    want = sorted(map(str, vectorize.term_counts(docs, "doc_id", words).collect()))
    totals = sorted(vectorize.term_totals(docs, words).collect())
    unit = sorted(map(str, vectorize.fit_tfidf(docs, words).transform(vectorize.term_counts(docs, "doc_id", words), "doc_id").withColumn("weight", F.round("weight", 9)).collect()))
    for module, name, value in ((vectorize, "PART_BYTES", 500), (vectorize, "SLICE_TOKENS", 50), (vectorize, "PART_ROWS", 100), (joins, "PART_ROWS", 100)):
        monkeypatch.setattr(module, name, value)
    counts = vectorize.term_counts(docs, "doc_id", words)
    assert counts.rdd.getNumPartitions() > 20
    assert sorted(map(str, counts.collect())) == want and sorted(vectorize.term_totals(docs, words).collect()) == totals
    fit = vectorize.fit_tfidf(docs, words).transform(counts, "doc_id")
    assert fit.rdd.getNumPartitions() > 20
    assert sorted(map(str, fit.withColumn("weight", F.round("weight", 9)).collect())) == unit


def test_words_are_cut_in_one_pass_and_stop_words_left_out_by_term(spark, tmp_path):
    texts = ["The the  cat,\tand a CAT_9\n", "", None, " İstanbul naïve — x y ", "a and", "Dog ½ 1,000.5 dog\x0bdog", "日本語 test", "..."]
    spark.createDataFrame([(i % 6, t, i) for i, t in enumerate(texts + ["filler"] * 22)], "doc_id long, text string, n int").write.parquet(f"{tmp_path}/documents.parquet")
    docs = text_plans.documents(spark, str(tmp_path))
    words = docs.select(tx.word_tokens(F.col("text")).alias("w"), tx.tokens(tx.words_only(F.col("text"))).alias("v"))
    assert words.where(~F.col("w").eqNullSafe(F.col("v"))).count() == 0
    assert "lambda" not in words.select("w")._jdf.queryExecution().optimizedPlan().toString()
    found = text_plans.pruned(spark, str(tmp_path))
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = vectorize.pruned_vocabulary(vectorize.term_totals(docs, tx.without_stop_words(tx.word_tokens(F.col("text")))), docs.agg(F.count(F.lit(1))).scalar(), max_df=0.1, max_features=5000)
    assert sorted(found.collect()) == sorted(want.collect()) and 5 < found.count() < 15


def test_topics_of_documents_without_text(spark, tmp_path):
    texts = [None, "", *(f"word{i % 40} other{i % 30} rare{i}" for i in range(60))]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.share, r.tokens) for r in pairs.d6_sums(spark, str(tmp_path)).collect()}
    assert len(got) == 62 and got[0] == got[1] == (0.0, 0) and got[2] == (1.0, 3)


def _wide_rows(spark, n, size, seed):
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        idx = np.sort(rng.choice(size, rng.integers(0, 12), replace=False))
        values = rng.random(len(idx))
        rows.append((i % (n - 5), float((values[idx < size // 2].sum() > values[idx >= size // 2].sum()) != (rng.random() < 0.2)), Vectors.sparse(size, idx.tolist(), values.tolist())))
    return spark.createDataFrame([*rows, *rows[:9]], ["id", "label", "features"])


@pytest.mark.parametrize("size, l2, rounds", [(40, 1e-4, 50), (2500, 1e-3, 12), (30, 0.0, 8)])
def test_weights_in_ranges_equal_those_of_one_machine(spark, monkeypatch, size, l2, rounds):
    """The same rounds, weights and scores as Spark's solver, with many blocks and ranges; copies and empty rows among them."""
    monkeypatch.setattr(wide, "BLOCK_ENTRIES", 60)
    rows = _wide_rows(spark, 130, size, seed=3).cache()
    one = classify.logistic(l2=l2, max_iter=rounds).fit(rows)
    many = wide.WideLogistic(l2=l2, max_iter=rounds).fit(rows)
    assert many.history == pytest.approx(list(one.summary.objectiveHistory), abs=1e-9)
    got = np.zeros(size)
    for row in many.weights().collect():
        got[row.idx] = row.coefficient
    assert got == pytest.approx(one.coefficients.toArray(), abs=1e-6) and many.intercept == pytest.approx(one.intercept, abs=1e-6)
    scores = [sorted((r.id, r.label, r.prediction, *r.rawPrediction, *r.probability) for r in m.transform(rows).collect()) for m in (one, many)]
    assert scores[1] == [pytest.approx(r, abs=1e-6) for r in scores[0]]


def test_weights_in_ranges_with_one_label(spark):
    rows = _wide_rows(spark, 30, 17, seed=1).withColumn("label", F.lit(1.0))
    assert {r.prediction for r in wide.WideLogistic().fit(rows).transform(rows).collect()} == {1.0}
    with pytest.raises(ValueError):
        wide.WideLogistic().fit(rows.withColumn("label", F.lit(2.0)))


def test_text_classifier_sends_no_gradient_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(learners.classify, "logistic", lambda *_, **__: pytest.fail("a gradient as wide as the vocabulary"))
    row = learners.w9(spark, "/root/testdata/sf0.001").first()
    assert row.n > 0 and 0 <= row.accuracy <= 1 and 0 <= row.auc <= 1


def test_splits_rank_only_rows_at_the_border(spark, monkeypatch):
    rows = [(i, None if i % 5 == 0 else f"s{i % 3}") for i in range(900)] + [(7, "s1")] * 3
    df = spark.createDataFrame(rows, "k long, label string")
    place = lambda k: md5(f"4:{k}".encode()).hexdigest()
    ranked = {}
    with monkeypatch.context() as m:
        m.setattr(sampling, "hashed_rank", lambda *_, **__: pytest.fail("all rows are ranked"))
        for share in (0.0, 0.3, 1.0):
            got = sampling.stratified_split(df, "k", "label", share, seed=4).collect()
            assert sorted((r.k, r.label or "") for r in got) == sorted((k, s or "") for k, s in rows)
            for label in {s for _, s in rows}:
                own = sorted((place(r.k), r.k, not r.is_test) for r in got if r.label == label)
                ranked[share, label] = [k for _, k, rest in own if not rest]
                assert ranked[share, label] == [k for _, k, _ in own][: int(share * len(own))]
        assert sampling.random_split(df, "k", 0.25, seed=4).where("is_test").count() == 225
        assert sampling.stratified_split(df.limit(0), "k", "label", 0.3, seed=4).count() == 0
    monkeypatch.setattr(sampling, "_STRATA", 2)
    many = sampling.stratified_split(df, "k", "label", 0.3, seed=4).where("is_test")
    assert sorted(r.k for r in many.collect()) == sorted(k for (share, _), ks in ranked.items() if share == 0.3 for k in ks)


def test_bags_settle_without_a_pass_where_the_step_is_small(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50000, 2))
    y = (x @ [1.0, -2.0] + rng.logistic(size=50000) > 0).astype(float)
    df = spark.createDataFrame([(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))], "id long, a double, b double, y double")
    tol = 2e-3
    fit = stacked.stacked_logistic(df, "id", ["a", "b"], "y", [stacked.Member(draw=i) for i in range(70)], tol=tol)
    assert fit.settled.all() and fit.passes == 1
    h = np.array([r.h for r in df.select("id", F.xxhash64(F.lit(1), "id").alias("h")).orderBy("id").collect()]).view(np.uint64)
    weight = stacked.draws(h, np.arange(70), 1.0)
    full = np.column_stack([np.ones(len(x)), x])
    p = 1 / (1 + np.exp(-full @ fit.weights.T))
    slope = np.einsum("im,im,ij->mj", weight, p - y[:, None], full) / weight.sum(axis=0)[:, None]
    assert np.abs(slope).max() < tol


@pytest.mark.parametrize("k, width", [(1, 2), (3, 2), (20, 2), (2, 9)])
def test_neighbours_are_picked_without_sorting(spark, monkeypatch, k, width):
    rng = np.random.default_rng(k)
    x = rng.integers(0, 7, (400, width)).astype(float) + 1000  # many ties
    train = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x[:330])], "id long, vec array<double>, label long")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[330:])], "id long, vec array<double>")
    d2 = ((x[330:, None] - x[None, :330]) ** 2).sum(axis=2)
    want = {(q, n, d2[q, n]) for q in range(70) for n in sorted(range(330), key=lambda n: (d2[q, n], n))[:k]}
    got = neighbors.nearest(train, asked, "id", "vec", "label", k).collect()
    assert {(r.query, r.neighbour, r.d2) for r in got} == want and len(got) == 70 * k
    if k <= neighbors._FEW:
        monkeypatch.setattr(np, "argsort", lambda *_, **__: pytest.fail("distances are sorted"))
        assert neighbors._smallest(d2.copy(), k).shape == (70, k)


def test_text_trees_are_read_in_bounded_listings(spark, monkeypatch, tmp_path):
    rows = [(i, f"text {i}\n\"{i % 7}\"", None if i == 5 else i % 2) for i in range(60)]
    spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(tabular, "TREE_FILES", 15, raising=False)
    seen, read = [], tabular.texttree.read_text_tree

    def listed(session, root, labels):
        seen.append(len(read(session, root, labels).inputFiles()))
        return read(session, root, labels)

    monkeypatch.setattr(tabular.texttree, "read_text_tree", listed)
    got = tabular.s5(spark, str(tmp_path)).collect()
    want = [("test" if i % 2 else "train", md5(f"{t}\n".encode()).hexdigest(), q) for i, t, q in rows if q is not None]
    assert sorted((r.split, r.text_md5, r.label) for r in got) == sorted(want)
    assert len(seen) == 4 and max(seen) < 30
