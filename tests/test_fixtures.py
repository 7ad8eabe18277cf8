"""Small literal inputs with known answers."""

import math

import pytest
from pyspark.sql import functions as F

from loomstat.functions import maths
from loomstat.functions import text as tx
from loomstat.functions.stemming import english_stem
from loomstat.operators import encode, ensemble, linear, linkage, missing, sampling, stats, vectorize
from loomstat.operators.columns import null_column
from loomstat.sources import delimited, generators, tables, texttree

CSV = "A,B,C,D\n1.0,2.0,3.0,4.0\n5.0,6.0,,8.0\n10.0,11.0,12.0"
SCHEMA = "A double, B double, C double, D double"
# Three sentences whose term counts and weights FIXTURES.md derives.
DOCS = [
    (1, "The sun is shining"),
    (2, "The weather is sweet"),
    (3, "The sun is shining, the weather is sweet, and one and one is two"),
]


@pytest.fixture(scope="module")
def holed(spark):
    return delimited.read_csv_text(spark, CSV, SCHEMA)


def test_missing(holed):
    assert {r.variable: r.nmissing for r in missing.null_counts(holed).collect()} == {"A": 0, "B": 0, "C": 1, "D": 1}
    assert missing.drop_incomplete_rows(holed).count() == 1
    assert missing.drop_incomplete_rows(holed, ["C"]).count() == 2
    assert missing.keep_rows_with(holed, 4).count() == 1
    assert missing.drop_columns_with_nulls(holed).columns == ["A", "B"]
    assert missing.drop_empty_columns(null_column(holed, "E")).columns == ["A", "B", "C", "D"]
    filled = missing.impute_mean(holed, ["A", "B", "C", "D"]).orderBy("A").collect()
    assert filled[1].C == 7.5 and filled[2].D == 6.0


def test_ragged_csv_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text(CSV)
    rows = delimited.read_csv(spark, str(tmp_path / "x.csv"), SCHEMA).orderBy("A").collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3, 4), (5, 6, None, 8), (10, 11, 12, None)]


def test_text_tree(spark, tmp_path):
    for split, label, name, text in (("train", "pos", "1", "good\nfilm"), ("test", "neg", "2", "bad")):
        (tmp_path / split / label).mkdir(parents=True)
        (tmp_path / split / label / f"{name}.txt").write_text(text)
    got = {tuple(r) for r in texttree.read_text_tree(spark, str(tmp_path), {"pos": 1, "neg": 0}).collect()}
    assert got == {("train", "good\nfilm", 1), ("test", "bad", 0)}


def test_mappings(spark):
    garments = tables.literal_frame(
        spark, [(0, "green", "M", 10.1, "class2"), (1, "red", "L", 13.5, "class1"), (2, "blue", "XL", 15.3, "class2")],
        "i int, color string, size string, price double, classlabel string",
    )
    sizes = encode.mapping_frame(spark, {"XL": 3, "L": 2, "M": 1}, "string", "int")
    coded = encode.lookup(garments, "size", sizes, "code")
    assert [r.code for r in coded.orderBy("i").collect()] == [1, 2, 3]
    back = encode.lookup(coded, "code", encode.inverted(sizes), "again")
    assert [r.again for r in back.orderBy("i").collect()] == ["M", "L", "XL"]
    classes = encode.first_appearance_codes(garments, "classlabel", "i")
    assert {r.key: r.value for r in classes.collect()} == {"class2": 1, "class1": 2}
    unknown = encode.lookup(garments, "color", encode.mapping_frame(spark, {"red": 1}, "string", "int"), "code")
    assert [r.code for r in unknown.orderBy("i").collect()] == [None, 1, None]
    kept = encode.replaced(garments, "color", encode.mapping_frame(spark, {"red": "rot"}, "string", "string"), "c")
    assert [r.c for r in kept.orderBy("i").collect()] == ["green", "rot", "blue"]


def test_label_and_one_hot_round_trip(spark):
    from pyspark.ml.functions import vector_to_array

    labels = spark.createDataFrame([(i, s) for i, s in enumerate(["M", "L", "XL", "M", "L", "M"])], "i int, s string")
    model = encode.label_indexer("s", "code").fit(labels)
    coded = model.transform(labels)
    assert [r.code for r in coded.orderBy("i").collect()] == [1, 0, 2, 1, 0, 1]
    decoded = encode.label_decoder("code", "again", model.labels).transform(coded)
    assert decoded.where("again <> s").count() == 0
    hot = encode.one_hot_encoder("code", "hot").fit(coded).transform(coded).withColumn("v", vector_to_array("hot"))
    assert all(sum(r.v) == 1 and len(r.v) == 3 for r in hot.collect())
    assert hot.where(encode.one_hot_label(F.col("v"), model.labels) != F.col("s")).count() == 0


def test_angle_of_parallel_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [0.5, 1.0, 1.5])], "a array<double>, b array<double>")
    assert df.select(maths.angle(F.col("a"), F.col("b"))).first()[0] == pytest.approx(0.0, abs=1e-7)


def test_votes(spark):
    votes = spark.createDataFrame([(1, 0, 0.2), (1, 0, 0.2), (1, 1, 0.6), (2, 1, 0.5), (2, 0, 0.5)], "k int, vote int, w double")
    got = {r.k: r.vote for r in stats.weighted_vote(votes, "k", "vote", "w").collect()}
    assert got == {1: 1, 2: 0}
    probs = spark.createDataFrame([(1, 0.9, 0.1, 0.2), (1, 0.8, 0.2, 0.2), (1, 0.4, 0.6, 0.6)], "k int, p0 double, p1 double, w double")
    row = stats.weighted_mean_vote(probs, "k", ["p0", "p1"], "w").first()
    assert (round(row.p0, 9), round(row.p1, 9), row.winner) == (0.58, 0.42, 0)


def test_boosting_step(spark):
    # fixed values: ten labels and guesses whose new weights FIXTURES.md derives
    y = [1, 1, 1, -1, -1, -1, 1, 1, 1, -1]
    guess = [1, 1, 1, -1, -1, -1, -1, -1, -1, -1]
    df = spark.createDataFrame([(a, b, 0.1) for a, b in zip(y, guess)], "y int, p int, w double")
    rows = ensemble.boosting_step(df, "y", "p", "w").collect()
    assert rows[0].error == pytest.approx(0.3) and rows[0].alpha == pytest.approx(0.4236489302)
    assert all(r.new_weight == pytest.approx(1 / 14 if r.y == r.p else 1 / 6) for r in rows)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string")


def test_vocabulary_and_tfidf(spark, docs):
    words = tx.word_tokens(F.col("text"))
    counts = vectorize.term_counts(docs, "doc_id", words)
    vocab = vectorize.vocabulary(vectorize.term_totals(docs, words)).orderBy("idx").collect()
    assert [r.term for r in vocab] == "and is one shining sun sweet the two weather".split()
    assert [r.df for r in vocab] == [1, 3, 1, 2, 2, 2, 3, 1, 2]
    assert [r.tf for r in counts.where("doc_id = 3").orderBy("term").collect()] == [2, 3, 2, 1, 1, 1, 2, 1, 1]
    fit = vectorize.fit_tfidf(docs, words)
    weights = fit.transform(counts, "doc_id")
    first = {r.term: round(r.weight, 4) for r in weights.where("doc_id = 1").collect()}
    assert first == {"is": 0.4337, "shining": 0.5585, "sun": 0.5585, "the": 0.4337}
    third = [round(r.weight, 4) for r in weights.where("doc_id = 3").orderBy("term").collect()]
    assert third == [0.5024, 0.4451, 0.5024, 0.1910, 0.1910, 0.1910, 0.2967, 0.2512, 0.1910]
    new = spark.createDataFrame([(9, "this is some new document weather and and")], "doc_id bigint, text string")
    unseen = vectorize.term_counts(new, "doc_id", tx.word_tokens(F.col("text")))
    assert sorted(r.term for r in fit.transform(unseen, "doc_id").collect()) == ["and", "is", "weather"]


def test_vectors_agree_with_the_long_form(spark, docs):
    from pyspark.ml.functions import vector_to_array

    words = tx.word_tokens(F.col("text"))
    more = docs.unionByName(spark.createDataFrame([(7, "")], docs.schema))
    vocab = vectorize.vocabulary(vectorize.term_totals(docs, words))
    weights = vectorize.fit_tfidf(docs, words).transform(vectorize.term_counts(docs, "doc_id", words), "doc_id")
    wide = vectorize.sparse_vectors(more, weights, vocab, "doc_id", "v").select("doc_id", vector_to_array("v").alias("v"))
    long = {(r.doc_id, r.term): r.weight for r in weights.collect()}
    assert {r.doc_id for r in wide.collect()} == {1, 2, 3, 7}
    terms = [r.term for r in vocab.orderBy("idx").collect()]
    for row in wide.collect():
        for term, value in zip(terms, row.v):
            assert value == pytest.approx(long.get((row.doc_id, term), 0.0))


def test_cleaner(spark):
    rows = [
        ("</a>This :) is :( a test :-)!", "this is a test  :) :( :)"),
        ("Café NAÏVE", "cafe naive"),
        ("", ""),
        ("<b></b>", ""),
    ]
    df = spark.createDataFrame(rows, "text string, want string")
    assert [r[0] for r in df.select(tx.clean(F.col("text"))).collect()] == [w for _, w in rows]
    assert df.select(F.size(tx.tokens(tx.clean(F.col("text")))).alias("n")).collect()[2].n == 0


def test_accents_follow_the_decomposition(spark):
    import unicodedata

    chars = [chr(c) for c in list(range(0x20, 0x3000, 7)) + list(range(0xA0, 0x250)) if unicodedata.category(chr(c)) != "Cn"]
    want = [unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x)[0] != "M")) for c in chars]
    df = spark.createDataFrame([(i, f"a{c}b") for i, c in enumerate(chars)], "i int, s string")
    got = [r.s for r in df.select("i", tx.strip_accents(F.col("s")).alias("s")).orderBy("i").collect()]
    assert got == [f"a{w}b" for w in want]
    decomposed = spark.createDataFrame([("été",)], "s string")
    assert decomposed.select(tx.strip_accents(F.col("s"))).first()[0] == "ete"


def test_tokens_and_stems(spark):
    df = spark.createDataFrame([("runners like running and thus they run",)], "text string")
    tokens = df.select(tx.tokens(F.col("text")).alias("t"), tx.without_stop_words(tx.tokens(F.col("text"))).alias("k")).first()
    assert len(tokens.t) == 7 and tokens.k == ["runners", "like", "running", "thus", "run"]
    pairs = "running run runner runner generously generous knightly knight happy happi cries cri ties tie gas gas hopping hop hoping hope agreed agre relational relat sensibiliti sensibl formalize formal adoption adopt controlling control dying die exceedingly exceed news news"
    words = pairs.split()
    assert [english_stem(w) for w in words[::2]] == words[1::2]
    counts = vectorize.stem_counts(df, tx.tokens(F.col("text")))
    assert {r.stem: r.n for r in counts.collect()}["run"] == 2


# Ten points whose fits FIXTURES.md derives.
POLY = list(zip(
    [258, 270, 294, 320, 342, 368, 396, 446, 480, 586],
    [236.4, 234.4, 252.8, 298.6, 314.2, 342.2, 360.8, 368.0, 391.2, 390.8],
))


def test_polynomial_regression(spark):
    df = spark.createDataFrame([(float(x), y) for x, y in POLY], "x double, y double")
    line = linear.gram(df, ["x"], "y")
    fit = line.least_squares()
    assert fit.b == pytest.approx(115.7855503) and fit.w[0] == pytest.approx(0.5403044, abs=1e-7)
    assert line.scores(fit) == {"mse": pytest.approx(569.779666), "r2": pytest.approx(0.831705, abs=1e-6)}
    wide = encode.with_polynomial(df, ["x"], 2)
    curve = linear.gram(wide, ["x", "x_x"], "y")
    fit = curve.least_squares()
    assert fit.b == pytest.approx(-243.228777) and fit.w[1] == pytest.approx(-0.00225020109)
    assert curve.scores(fit) == {"mse": pytest.approx(61.330215), "r2": pytest.approx(0.981885, abs=1e-6)}


def test_grid_has_36_rows(spark):
    one = spark.range(1)
    assert generators.range_rows(one, F.lit(250), F.lit(600), F.lit(10), "x").count() == 36


def test_rebalancing(spark):
    keys = spark.range(500).withColumnRenamed("id", "k")
    data = generators.uniform_matrix(keys, "k", 2, (F.col("k") < 450).cast("int"), seed=1)
    counts = {r.label: r.n for r in stats.value_counts(sampling.rebalanced(data, "k", "label", 1, 0, seed=123), "label").collect()}
    assert counts == {0: 450, 1: 450}


def test_complete_linkage_on_a_line(spark):
    items = spark.createDataFrame([(10 * i, [x]) for i, x in enumerate([0.0, 1.0, 5.0, 7.0, 20.0])], "id bigint, vec array<double>")
    tree = linkage.merge_tree(items, "id", "vec").orderBy("step").collect()
    assert [(t.left, t.right, t.distance) for t in tree] == [(0, 1, 1.0), (2, 3, 2.0), (5, 6, 7.0), (7, 4, 20.0)]
    merges = linkage.complete_linkage(linkage.pair_distances(items, "id", "vec"))
    for k, want in ((2, [0, 0, 0, 0, 1]), (3, [0, 0, 1, 1, 2]), (5, [0, 1, 2, 3, 4]), (1, [0] * 5)):
        assert [c.cluster for c in linkage.cut(merges, items, "id", k).orderBy("id").collect()] == want



def test_blobs_have_their_spread(spark):
    made = generators.blobs(spark.range(3000), "id", 2, 3, 0.5, seed=123)
    for row in made.groupBy("center").agg(F.count("*").alias("n"), F.stddev("x0").alias("s")).collect():
        assert row.n == 1000 and math.isclose(row.s, 0.5, rel_tol=0.1)
