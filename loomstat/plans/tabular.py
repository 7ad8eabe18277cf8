"""Sources, projections, lookups, missing values, encoding, sampling, statistics, order."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomstat.functions import maths
from loomstat.functions.hashing import poisson_thresholds
from loomstat.operators import columns, encode, missing, sampling, stats
from loomstat.operators.ordering import ordered_rank, running_totals
from loomstat.plans.registry import (
    SQL_HOLED,
    SQL_LINES,
    big,
    holed_lines,
    lines,
    query,
    r,
    sql_hash,
    sql_round,
    sql_uniform,
)
from loomstat.session import new_path
from loomstat.sources import delimited, generators, tables, texttree
from loomstat.sources.tables import table

TREE_FILES = 20_000  # files of a text tree, all listed by the driver

# ---- sources and sinks ------------------------------------------------------


@query("s1_labelled_dataset", f"SELECT id, qty, price, disc, tax, CAST(flag = 'R' AS BIGINT) AS label FROM {SQL_LINES}")
def s1(spark, d):
    return tables.labelled(lines(spark, d), "id", ["qty", "price", "disc", "tax"], big(F.col("flag") == "R"))


@query(
    "s2_csv_short_rows",
    f"""SELECT id, CASE WHEN num % 4 <> 0 THEN qty END AS a, disc AS b, CASE WHEN num % 3 <> 0 THEN tax END AS c
    FROM {SQL_LINES}""",
)
def s2(spark, d):
    """Lines with empty cells and rows that end early come back with NULLs."""
    path, df = new_path(spark, "short-rows"), lines(spark, d)
    a = F.when(F.col("num") % 4 != 0, F.col("qty").cast("string")).otherwise("")
    cells = F.array_append(F.array("id", a, F.col("disc").cast("string")), F.col("tax").cast("string"))
    kept = F.when(F.col("num") % 3 != 0, cells).otherwise(F.slice(cells, 1, 3))
    df.select(F.array_join(kept, ",")).write.text(path)
    return delimited.read_csv(spark, path, "id string, a double, b double, c double", header=False)


@query("s3_csv_long_text", "SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS chars FROM documents")
def s3(spark, d):
    """Whole documents, with line breaks and quotes, through CSV and back."""
    path = new_path(spark, "documents-csv")
    delimited.write_csv(table(spark, d, "documents").select("doc_id", "text"), path)
    back = delimited.read_csv(spark, path, "doc_id bigint, text string", multiline=True)
    return back.select("doc_id", F.md5("text").alias("text_md5"), big(F.length("text")).alias("chars"))


@query("s4_tab_delimited", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def s4(spark, d):
    path = new_path(spark, "orders-tsv")
    delimited.write_csv(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), path, sep="\t")
    return delimited.read_csv(spark, path, "o_orderkey bigint, o_totalprice double, o_orderpriority string", sep="\t")


@query(
    "s5_text_tree",
    """SELECT CASE WHEN doc_id % 2 = 0 THEN 'train' ELSE 'test' END AS split, md5(text||chr(10)) AS text_md5,
    CAST(quality AS BIGINT) AS label FROM documents JOIN labels USING (doc_id)""",
)
def s5(spark, d):
    """One file per labelled document below <split>/<label>/, read whole; a tree takes some ``TREE_FILES`` files, as the driver lists them."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("doc_id", "text", "quality")
    trees, cores = max(1, math.ceil(docs.count() / TREE_FILES)), spark.sparkContext.defaultParallelism
    kept, whole = new_path(spark, "text-docs"), new_path(spark, "text-rows")
    placed = docs.withColumn("tree", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(trees)))
    parts = max(2 * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed.repartition(parts, "tree", F.pmod(F.xxhash64("doc_id"), F.lit(2 * cores))).write.partitionBy("tree").parquet(kept)
    for k in range(trees):
        own = spark.read.schema(placed.schema).parquet(kept).where(F.col("tree") == k)
        _text_tree(spark, own).write.mode("append").parquet(whole)
    return spark.read.schema("split string, text_md5 string, label bigint").parquet(whole)


def _text_tree(spark, docs):
    root = new_path(spark, "text-tree")
    for split, rest in (("train", 0), ("test", 1)):
        for name, quality in (("pos", 1), ("neg", 0)):
            part = docs.where((F.col("doc_id") % 2 == rest) & (F.col("quality") == quality))
            # tasks move their files into place themselves; the driver would move them one by one
            commit = {"mapreduce.fileoutputcommitter.algorithm.version": 2}
            part.select("text").write.options(maxRecordsPerFile=1, **commit).text(f"{root}/{split}/{name}")
    # a task reads many files; with a few each, the driver would hold as many tasks
    tree = texttree.read_text_tree(spark, root, {"pos": 1, "neg": 0}).coalesce(4 * spark.sparkContext.defaultParallelism)
    return tree.select("split", F.md5("text").alias("text_md5"), big("label").alias("label"))


@query(
    "s6_write_csv",
    f"""SELECT c_mktsegment, count(*) AS n, {sql_round('sum(c_acctbal)', 4)} AS balance FROM customer GROUP BY 1""",
)
def s6(spark, d):
    path = new_path(spark, "customers-csv")
    delimited.write_csv(table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), path)
    back = delimited.read_csv(spark, path, "c_custkey bigint, c_mktsegment string, c_acctbal double")
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), r(F.sum("c_acctbal"), 4).alias("balance"))


@query(
    "s7_literal_frame",
    """SELECT name, count(*) AS n FROM lineitem
    JOIN (VALUES ('A','accepted'),('N','new'),('R','returned')) v(flag, name) ON flag = l_returnflag GROUP BY 1""",
)
def s7(spark, d):
    names = tables.literal_frame(spark, [("A", "accepted"), ("N", "new"), ("R", "returned")], "l_returnflag string, name string")
    return table(spark, d, "lineitem").join(F.broadcast(names), "l_returnflag").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


_CENTER = "CAST(o_orderkey % 3 AS BIGINT)"


def _sql_gauss(seed, key):
    return f"sqrt(-2.0*ln(1.0-{sql_uniform(seed, key)}))*cos(2.0*pi()*{sql_uniform(seed + 1, key)})"


def _sql_blob(f):
    middle = sql_uniform(123, f"'c:'||{_CENTER}||':{f}'") + "*20.0-10.0"
    return sql_round(f"{middle} + 0.5*{_sql_gauss(123, chr(39) + 'x:' + chr(39) + f'||o_orderkey||' + chr(39) + f':{f}' + chr(39))}")


@query("s8_gaussian_blobs", f"SELECT o_orderkey, {_CENTER} AS center, {_sql_blob(0)} AS x0, {_sql_blob(1)} AS x1 FROM orders")
def s8(spark, d):
    made = generators.blobs(table(spark, d, "orders"), "o_orderkey", n_features=2, centers=3, std=0.5, seed=123)
    return made.select("o_orderkey", "center", r("x0").alias("x0"), r("x1").alias("x1"))


@query(
    "s9_uniform_matrix",
    f"""SELECT c_custkey, {sql_uniform(5, "c_custkey||':0'")} AS x0, {sql_uniform(5, "c_custkey||':1'")} AS x1,
    CAST(row_number() OVER (ORDER BY c_custkey) <= 0.9 * count(*) OVER () AS BIGINT) AS label FROM customer""",
)
def s9(spark, d):
    """Uniform features, the first nine tenths of the rows in class 1."""
    ranked = ordered_rank(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], "rn", with_total=True)
    label = big(F.col("rn") <= F.lit(0.9) * F.col("rn_total"))
    return generators.uniform_matrix(ranked, "c_custkey", 2, label, seed=5)


@query(
    "s10_scoring_grid",
    f"""WITH f AS (SELECT regr_slope(p_retailprice, p_size) w, regr_intercept(p_retailprice, p_size) b,
      min(p_size) - 1 lo, max(p_size) + 2 hi FROM part)
    SELECT CAST(x AS BIGINT) AS x, {sql_round('b + w * x')} AS prediction FROM f, LATERAL (SELECT unnest(range(lo, hi + 1)) AS x)""",
)
def s10(spark, d):
    """An even grid one step wider than the data, scored by the fitted line."""
    fitted = table(spark, d, "part").agg(
        F.regr_slope("p_retailprice", "p_size").alias("w"),
        F.regr_intercept("p_retailprice", "p_size").alias("b"),
        big(F.min("p_size") - 1).alias("lo"),
        big(F.max("p_size") + 2).alias("hi"),
    )
    grid = generators.range_rows(fitted, F.col("lo"), F.col("hi"), F.lit(1).cast("bigint"), "x")
    return grid.select("x", r(F.col("b") + F.col("w") * F.col("x")).alias("prediction"))


# ---- projection and filter --------------------------------------------------


@query("p1_columns_by_position", "SELECT p_partkey, p_brand, CAST(p_size AS BIGINT) AS p_size FROM part")
def p1(spark, d):
    """First, third and last-but-one column."""
    picked = columns.columns_at(table(spark, d, "part"), [0, 2, -2])
    return picked.withColumn("p_size", big("p_size"))


@query("p2_all_but", "SELECT * EXCLUDE (o_orderdate, o_totalprice) FROM orders")
def p2(spark, d):
    return columns.all_but(table(spark, d, "orders"), "o_orderdate", "o_totalprice")


@query("p3_rename_all", "SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation, s_acctbal AS balance FROM supplier")
def p3(spark, d):
    return columns.renamed(table(spark, d, "supplier"), ["id", "name", "nation", "balance"]).withColumn("nation", big("nation"))


@query(
    "p4_row_filter",
    f"""SELECT id, qty, price FROM {SQL_LINES} WHERE (flag = 'A' OR flag = 'R') AND status <> 'O' AND price < 40000 AND NOT (qty > 25)""",
)
def p4(spark, d):
    keep = F.col("flag").isin("A", "R") & (F.col("status") != "O") & (F.col("price") < 40000) & ~(F.col("qty") > 25)
    return lines(spark, d).where(keep).select("id", "qty", "price")


@query(
    "p5_rows_by_position",
    """SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) rn FROM orders)
    WHERE rn BETWEEN 51 AND 1050""",
)
def p5(spark, d):
    """Rows 51 to 1050 by price."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return columns.head_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 51, 1050)


@query("p6_transform_by_row", "SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS done FROM orders")
def p6(spark, d):
    done = columns.recode(F.col("o_orderstatus"), {"F": F.lit(1)}, F.lit(0))
    return table(spark, d, "orders").select("o_orderkey", big(done).alias("done"))


@query(
    "p7_recode",
    f"""SELECT id, CAST(CASE flag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS BIGINT) AS code, flag = 'R' AS returned FROM {SQL_LINES}""",
)
def p7(spark, d):
    code = columns.recode(F.col("flag"), {"A": F.lit(0), "N": F.lit(1)}, F.lit(2))
    return lines(spark, d).select("id", big(code).alias("code"), (F.col("flag") == "R").alias("returned"))


@query("p8_null_column", "SELECT c_custkey, c_acctbal, CAST(NULL AS DOUBLE) AS extra FROM customer")
def p8(spark, d):
    return columns.null_column(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "extra")


@query("p9_replace_column", "SELECT p_partkey, upper(replace(p_name, ' ', '_')) AS p_name FROM part")
def p9(spark, d):
    shout = F.upper(F.replace("p_name", F.lit(" "), F.lit("_")))
    return table(spark, d, "part").select("p_partkey", "p_name").withColumn("p_name", shout)


@query(
    "p11_feature_vector",
    f"SELECT p_partkey, CAST(p_size AS DOUBLE) AS f0, p_retailprice AS f1, CAST(2 AS BIGINT) AS width FROM part",
)
def p11(spark, d):
    from pyspark.ml.functions import vector_to_array

    vec = columns.to_features(table(spark, d, "part"), ["p_size", "p_retailprice"])
    values = vec.select("p_partkey", vector_to_array("features").alias("v"))
    return values.select("p_partkey", F.col("v")[0].alias("f0"), F.col("v")[1].alias("f1"), big(F.size("v")).alias("width"))


@query(
    "p12_scalar_maths",
    f"""SELECT id, {sql_round('exp(-disc)')} AS e, {sql_round('ln(price)')} AS l, {sql_round('log2(price)')} AS l2,
    {sql_round('log10(price)')} AS l10, {sql_round('sqrt(qty)')} AS s, {sql_round('abs(qty - 25)')} AS a,
    {sql_round('acos(disc)')} AS ac, {sql_round('pow(qty, 2)')} AS p, {sql_round('price', 1)} AS r1 FROM {SQL_LINES}""",
)
def p12(spark, d):
    qty, price, disc = F.col("qty"), F.col("price"), F.col("disc")
    return lines(spark, d).select(
        "id",
        r(F.exp(-disc)).alias("e"),
        r(F.ln(price)).alias("l"),
        r(F.log2(price)).alias("l2"),
        r(F.log10(price)).alias("l10"),
        r(F.sqrt(qty)).alias("s"),
        r(F.abs(qty - 25)).alias("a"),
        r(F.acos(disc)).alias("ac"),
        r(F.pow(qty, F.lit(2))).alias("p"),
        r(price, 1).alias("r1"),
    )


@query(
    "p13_logistic_loss",
    f"""WITH z AS (SELECT id, (qty - 25) / 10 AS z, CAST(flag = 'R' AS INT) AS y FROM {SQL_LINES})
    SELECT id, {sql_round('1/(1+exp(-z))')} AS p,
    {sql_round('CASE WHEN y = 1 THEN -ln(1/(1+exp(-z))) ELSE -ln(1-1/(1+exp(-z))) END')} AS loss FROM z""",
)
def p13(spark, d):
    z, y = (F.col("qty") - 25) / 10, (F.col("flag") == "R").cast("int")
    return lines(spark, d).select("id", r(maths.sigmoid(z)).alias("p"), r(maths.log_loss(z, y)).alias("loss"))


# ---- joins ------------------------------------------------------------------

# An ordinal scale for the order priorities; one is left out on purpose.
PRIORITY_RANK = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 5}
_SQL_RANK = "(VALUES ('1-URGENT',1),('2-HIGH',2),('3-MEDIUM',3),('5-LOW',5)) m(k, v)"


@query(
    "j1_lookup_with_default",
    f"SELECT o_orderkey, CAST(v AS BIGINT) AS rank FROM orders LEFT JOIN {_SQL_RANK} ON k = o_orderpriority",
)
def j1(spark, d):
    mapping = encode.mapping_frame(spark, PRIORITY_RANK, "string", "bigint")
    return encode.lookup(table(spark, d, "orders"), "o_orderpriority", mapping, "rank").select("o_orderkey", "rank")


@query(
    "j2_pair_by_id",
    """SELECT count(*) AS n, CAST(sum(CAST((l.quality = 1) <> (d.n_chars > 500) AS INT)) AS BIGINT) AS wrong
    FROM documents d JOIN labels l USING (doc_id)""",
)
def j2(spark, d):
    """Predictions and truth from two tables, paired by id."""
    predicted = table(spark, d, "documents").select("doc_id", (F.col("n_chars") > 500).alias("prediction"))
    truth = table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("label"))
    both = predicted.join(truth, "doc_id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") != F.col("prediction")).alias("wrong"))


# ---- missing values -----------------------------------------------------------


@query(
    "m1_null_counts",
    f"""WITH t AS {SQL_HOLED} SELECT 'id' AS variable, count(*) - count(id) AS nmissing FROM t
    UNION ALL SELECT 'a', count(*) - count(a) FROM t UNION ALL SELECT 'b', count(*) - count(b) FROM t
    UNION ALL SELECT 'c', count(*) - count(c) FROM t UNION ALL SELECT 'd', count(*) - count(d) FROM t
    UNION ALL SELECT 'e', count(*) - count(e) FROM t""",
)
def m1(spark, d):
    return missing.null_counts(holed_lines(spark, d))


@query("m2_drop_incomplete", f"SELECT id, a, b, c, d FROM {SQL_HOLED} WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND d IS NOT NULL")
def m2(spark, d):
    return missing.drop_incomplete_rows(holed_lines(spark, d).drop("e"))


@query("m3_drop_by_column", f"SELECT id, a, b, c, d FROM {SQL_HOLED} WHERE b IS NOT NULL")
def m3(spark, d):
    return missing.drop_incomplete_rows(holed_lines(spark, d).drop("e"), ["b"])


@query("m4_drop_holed_columns", f"SELECT id, c FROM {SQL_HOLED}")
def m4(spark, d):
    return missing.drop_columns_with_nulls(holed_lines(spark, d))


@query("m5_drop_empty_columns", f"SELECT id, a, b, c, d FROM {SQL_HOLED}")
def m5(spark, d):
    return missing.drop_empty_columns(holed_lines(spark, d))


@query(
    "m6_rows_with_n_values",
    f"""SELECT * FROM {SQL_HOLED} WHERE 2 + CAST(a IS NOT NULL AS INT) + CAST(b IS NOT NULL AS INT) + CAST(d IS NOT NULL AS INT) >= 4""",
)
def m6(spark, d):
    return missing.keep_rows_with(holed_lines(spark, d), 4)


@query(
    "m7_impute_mean",
    f"""WITH t AS {SQL_HOLED}, s AS (SELECT avg(a) ma, avg(b) mb, avg(d) md FROM t)
    SELECT id, {sql_round('coalesce(a, ma)')} AS a, {sql_round('coalesce(b, mb)')} AS b, c, {sql_round('coalesce(d, md)')} AS d FROM t, s""",
)
def m7(spark, d):
    filled = missing.impute_mean(holed_lines(spark, d).drop("e"), ["a", "b", "d"])
    return filled.select("id", r("a").alias("a"), r("b").alias("b"), "c", r("d").alias("d"))


# ---- encoding and scaling -----------------------------------------------------


@query("e1_ordinal_map", f"SELECT o_orderpriority, CAST(v AS BIGINT) AS code, count(*) AS n FROM orders LEFT JOIN {_SQL_RANK} ON k = o_orderpriority GROUP BY ALL")
def e1(spark, d):
    mapping = encode.mapping_frame(spark, PRIORITY_RANK, "string", "bigint")
    coded = encode.lookup(table(spark, d, "orders"), "o_orderpriority", mapping, "code")
    return coded.groupBy("o_orderpriority", "code").agg(F.count(F.lit(1)).alias("n"))


@query("e2_inverse_map", f"SELECT o_orderkey, k AS label FROM orders LEFT JOIN {_SQL_RANK} ON k = o_orderpriority")
def e2(spark, d):
    mapping = encode.mapping_frame(spark, PRIORITY_RANK, "string", "bigint")
    coded = encode.lookup(table(spark, d, "orders"), "o_orderpriority", mapping, "code")
    back = encode.lookup(coded, "code", F.broadcast(encode.inverted(mapping)), "label")
    return back.select("o_orderkey", "label")


@query(
    "e3_first_appearance_codes",
    """SELECT label, row_number() OVER (ORDER BY first) AS code FROM (SELECT p_brand AS label, min(p_partkey) AS first FROM part GROUP BY 1)""",
)
def e3(spark, d):
    codes = encode.first_appearance_codes(table(spark, d, "part"), "p_brand", "p_partkey")
    return codes.select(F.col("key").alias("label"), F.col("value").alias("code"))


@query(
    "e4_replace_pairs",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status FROM orders",
)
def e4(spark, d):
    mapping = encode.mapping_frame(spark, {"F": "final", "O": "open"}, "string", "string")
    return encode.replaced(table(spark, d, "orders"), "o_orderstatus", mapping, "status").select("o_orderkey", "status")


@query("e5_label_encode", "SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code FROM customer")
def e5(spark, d):
    customers = table(spark, d, "customer")
    model = encode.label_indexer("c_mktsegment", "code").fit(customers)
    return model.transform(customers).select("c_custkey", big("code").alias("code"))


@query("e6_label_decode", "SELECT c_custkey, c_mktsegment AS label FROM customer")
def e6(spark, d):
    customers = table(spark, d, "customer")
    model = encode.label_indexer("c_mktsegment", "code").fit(customers)
    coded = model.transform(customers).select("c_custkey", "code")
    return encode.label_decoder("code", "label", model.labels).transform(coded).select("c_custkey", "label")


def _one_hot(spark, d):
    from pyspark.ml.functions import vector_to_array

    customers = table(spark, d, "customer")
    index = encode.label_indexer("c_mktsegment", "code").fit(customers)
    coded = index.transform(customers)
    hot = encode.one_hot_encoder("code", "hot").fit(coded).transform(coded)
    return hot.select("c_custkey", vector_to_array("hot").alias("v")), index.labels


@query(
    "e7_one_hot",
    """SELECT c_custkey, pos - 1 AS position, CAST(seg = c_mktsegment AS BIGINT) AS value FROM customer,
    (SELECT seg, row_number() OVER (ORDER BY seg) AS pos FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer))""",
)
def e7(spark, d):
    hot, _ = _one_hot(spark, d)
    return hot.select("c_custkey", F.posexplode("v").alias("position", "value")).select(
        "c_custkey", big("position").alias("position"), big("value").alias("value")
    )


@query("e8_one_hot_decode", "SELECT c_custkey, c_mktsegment AS label FROM customer")
def e8(spark, d):
    hot, labels = _one_hot(spark, d)
    return hot.select("c_custkey", encode.one_hot_label(F.col("v"), labels).alias("label"))


_SQL_SPLIT = f"""(SELECT *, rn <= floor(0.3 * n) AS is_test FROM (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY {sql_hash(1, 'id')}) AS rn,
 count(*) OVER (PARTITION BY flag) AS n FROM {SQL_LINES}))"""


def split_lines(spark, d):
    """lineitem with a 30 % test share of each return flag."""
    return sampling.stratified_split(lines(spark, d), "id", "flag", 0.3, seed=1)


@query(
    "e9_standard_scaler",
    f"""WITH t AS {_SQL_SPLIT}, s AS (SELECT avg(qty) mq, stddev_samp(qty) sq, avg(price) mp, stddev_samp(price) sp FROM t WHERE NOT is_test)
    SELECT id, is_test, {sql_round('(qty-mq)/sq')} AS qty, {sql_round('(price-mp)/sp')} AS price FROM t, s""",
)
def e9(spark, d):
    """Fitted on the training rows, applied to all."""
    rows = split_lines(spark, d)
    scaler = encode.fit_standard_scaler(rows.where(~F.col("is_test")), ["qty", "price"])
    return scaler.transform(rows).select("id", "is_test", r("qty").alias("qty"), r("price").alias("price"))


@query(
    "e10_z_score",
    f"""SELECT id, {sql_round('(qty - avg(qty) OVER ()) / stddev_samp(qty) OVER ()')} AS qty,
    {sql_round('(price - avg(price) OVER ()) / stddev_samp(price) OVER ()')} AS price FROM {SQL_LINES}""",
)
def e10(spark, d):
    z = encode.standardised(lines(spark, d), ["qty", "price"])
    return z.select("id", r("qty").alias("qty"), r("price").alias("price"))


@query("e11_unscale", f"SELECT id, {sql_round('qty')} AS qty, {sql_round('price')} AS price FROM {SQL_LINES}")
def e11(spark, d):
    rows = lines(spark, d)
    scaler = encode.fit_standard_scaler(rows, ["qty", "price"])
    back = scaler.inverse(scaler.transform(rows))
    return back.select("id", r("qty").alias("qty"), r("price").alias("price"))


@query(
    "e12_min_max",
    f"""WITH t AS {_SQL_SPLIT}, s AS (SELECT min(qty) lq, max(qty) hq, min(price) lp, max(price) hp FROM t WHERE NOT is_test)
    SELECT id, {sql_round('(qty-lq)/(hq-lq)')} AS qty, {sql_round('(price-lp)/(hp-lp)')} AS price FROM t, s""",
)
def e12(spark, d):
    rows = split_lines(spark, d)
    scaler = encode.fit_min_max_scaler(rows.where(~F.col("is_test")), ["qty", "price"])
    return scaler.transform(rows).select("id", r("qty").alias("qty"), r("price").alias("price"))


@query(
    "e13_polynomial",
    f"""SELECT id, qty, disc, {sql_round('qty*qty')} AS qty_qty, {sql_round('qty*disc')} AS qty_disc, {sql_round('disc*disc')} AS disc_disc,
    {sql_round('qty*qty*qty')} AS qty_qty_qty, {sql_round('qty*qty*disc')} AS qty_qty_disc,
    {sql_round('qty*disc*disc')} AS qty_disc_disc, {sql_round('disc*disc*disc')} AS disc_disc_disc FROM {SQL_LINES}""",
)
def e13(spark, d):
    terms = encode.polynomial_terms(["qty", "disc"], 3)
    return lines(spark, d).select("id", *[(e if n in ("qty", "disc") else r(e)).alias(n) for n, e in terms.items()])


# ---- partitioning and sampling --------------------------------------------------


@query("l1_stratified_split", f"SELECT id, flag, is_test FROM {_SQL_SPLIT}")
def l1(spark, d):
    return split_lines(spark, d).select("id", "flag", "is_test")


@query(
    "l2_random_split",
    f"""SELECT o_orderkey, row_number() OVER (ORDER BY {sql_hash(123, 'o_orderkey')}) <= floor(0.3 * count(*) OVER ()) AS is_test FROM orders""",
)
def l2(spark, d):
    return sampling.random_split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.3, seed=123)


@query(
    "l3_stratified_folds",
    "SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) % 10 AS BIGINT) AS fold FROM orders",
)
def l3(spark, d):
    folds = sampling.stratified_folds(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", 10)
    return folds.select("o_orderkey", big("fold").alias("fold"))


@query(
    "l4_shuffled_folds",
    f"SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {sql_hash(42, 'o_orderkey')}) - 1) % 3 AS BIGINT) AS fold FROM orders",
)
def l4(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_folds(rows, "o_orderkey", "o_orderstatus", 3, seed=42).select("o_orderkey", big("fold").alias("fold"))


def _sql_resample(source: str, key: str, n: str, seed: int) -> str:
    return f"""SELECT draw, t.* EXCLUDE (rn) FROM (SELECT unnest(range({n})) AS draw) g
    JOIN (SELECT *, row_number() OVER (ORDER BY {key}) AS rn FROM {source}) t
    ON t.rn = floor({sql_uniform(seed, 'draw')} * (SELECT count(*) FROM {source})) + 1"""


@query("l5_resample", _sql_resample("(SELECT c_custkey, c_acctbal FROM customer)", "c_custkey", "5000", 123))
def l5(spark, d):
    """Exactly 5000 rows with replacement."""
    return sampling.resample(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_custkey", 5000, seed=123)


@query(
    "l6_rebalance",
    f"""SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM labels WHERE quality = 1 UNION ALL
    SELECT doc_id, quality FROM ({_sql_resample("(SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM labels WHERE quality = 0)",
                                                "doc_id", "(SELECT count(*) FROM labels WHERE quality = 1)", 123)})""",
)
def l6(spark, d):
    labels = table(spark, d, "labels").select("doc_id", big("quality").alias("quality"))
    return sampling.rebalanced(labels, "doc_id", "quality", 1, 0, seed=123)


@query("l7_shuffle", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {sql_hash(0, 'o_orderkey')}")
def l7(spark, d):
    return sampling.shuffled(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", seed=0)


_POISSON = " + ".join(f"CAST(u >= {t!r} AS BIGINT)" for t in poisson_thresholds())


@query(
    "l8_bootstrap_weights",
    f"""WITH w AS (SELECT member, {sql_uniform(1, "member||':'||c_custkey")} AS u, c_acctbal FROM customer, (SELECT unnest(range(10)) AS member)),
    x AS (SELECT member, {_POISSON} AS weight, c_acctbal FROM w)
    SELECT member, count(*) AS rows, CAST(sum(weight) AS BIGINT) AS drawn, {sql_round('sum(weight*c_acctbal)/sum(weight)')} AS mean_balance
    FROM x WHERE weight > 0 GROUP BY 1""",
)
def l8(spark, d):
    drawn = sampling.bootstrap_weights(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_custkey", 10, seed=1)
    mean = F.sum(F.col("weight") * F.col("c_acctbal")) / F.sum("weight")
    return drawn.groupBy(big("member").alias("member")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("drawn"), r(mean).alias("mean_balance")
    )


# ---- aggregation and statistics ---------------------------------------------------


@query("a1_mean_std", f"SELECT flag, {sql_round('avg(price)')} AS mean, {sql_round('stddev_samp(price)')} AS std FROM {SQL_LINES} GROUP BY 1")
def a1(spark, d):
    return lines(spark, d).groupBy("flag").agg(r(F.avg("price")).alias("mean"), r(F.stddev_samp("price")).alias("std"))


@query("a2_value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def a2(spark, d):
    return stats.value_counts(table(spark, d, "orders"), "o_orderpriority")


@query(
    "a3_weighted_vote",
    f"""WITH w AS (SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS vote, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2),
    q AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY w DESC, vote) AS rn FROM w)
    SELECT k AS l_orderkey, vote, w AS weight FROM q WHERE rn = 1""",
)
def a3(spark, d):
    """The line number with the largest quantity per order."""
    votes = table(spark, d, "lineitem").select("l_orderkey", big("l_linenumber").alias("vote"), "l_quantity")
    return stats.weighted_vote(votes, "l_orderkey", "vote", "l_quantity")


@query(
    "a4_weighted_mean_vote",
    f"""WITH m AS (SELECT l_suppkey, {sql_round('sum(l_quantity*l_discount)/sum(l_quantity)', 9)} AS p0, {sql_round('sum(l_quantity*l_tax)/sum(l_quantity)', 9)} AS p1
    FROM lineitem GROUP BY 1) SELECT *, CAST(CASE WHEN p0 >= p1 THEN 0 ELSE 1 END AS BIGINT) AS winner FROM m""",
)
def a4(spark, d):
    rows = table(spark, d, "lineitem").withColumnsRenamed({"l_discount": "p0", "l_tax": "p1"})
    means = stats.weighted_mean_vote(rows, "l_suppkey", ["p0", "p1"], "l_quantity")
    return means.select("l_suppkey", r("p0", 9).alias("p0"), r("p1", 9).alias("p1"), "winner")


@query("a5_conditional_count", f"SELECT CAST(count_if(flag = 'R') AS BIGINT) AS returned, {sql_round('sum(CASE WHEN disc > 0.05 THEN price ELSE 0 END)', 2)} AS discounted FROM {SQL_LINES}")
def a5(spark, d):
    return lines(spark, d).agg(
        F.count_if(F.col("flag") == "R").alias("returned"),
        r(F.sum(F.when(F.col("disc") > 0.05, F.col("price")).otherwise(0)), 2).alias("discounted"),
    )


_NUMERIC = ["qty", "price", "disc", "tax"]


def _sql_matrix(function: str, digits: int) -> str:
    cells = [
        f"SELECT CAST({i} AS BIGINT) AS i, CAST({j} AS BIGINT) AS j, {sql_round(f'{function}({a}, {b})', digits)} AS value FROM t"
        for i, a in enumerate(_NUMERIC)
        for j, b in enumerate(_NUMERIC)
    ]
    return f"WITH t AS {SQL_LINES} " + " UNION ALL ".join(cells)


@query("a6_covariance", _sql_matrix("covar_samp", 4))
def a6(spark, d):
    return stats.covariance_matrix(lines(spark, d), _NUMERIC).select("i", "j", r("value", 4).alias("value"))


@query("a7_correlation", _sql_matrix("corr", 8))
def a7(spark, d):
    return stats.covariance_matrix(lines(spark, d), _NUMERIC, correlation=True).select("i", "j", r("value", 8).alias("value"))


@query(
    "a6_vector_covariance",
    f"""WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS k FROM embeddings)
    SELECT a.k AS i, b.k AS j, {sql_round('covar_samp(a.v, b.v)')} AS value FROM e a JOIN e b USING (vec_id) GROUP BY 1, 2""",
)
def a6_vector(spark, d):
    """64 x 64 covariances of the embeddings from partial products per task."""
    return stats.vector_covariance(table(spark, d, "embeddings"), "embedding", 64).select("i", "j", r("value").alias("value"))


@query("a8_min_max", f"SELECT flag, min(price) AS low, max(price) AS high FROM {SQL_LINES} GROUP BY 1")
def a8(spark, d):
    return lines(spark, d).groupBy("flag").agg(F.min("price").alias("low"), F.max("price").alias("high"))


@query("a9_mean_absolute_deviation", f"SELECT {sql_round('avg(abs(price - (SELECT avg(price) FROM ' + SQL_LINES + ')))')} AS mad FROM {SQL_LINES}")
def a9(spark, d):
    return stats.mean_absolute_deviation(lines(spark, d), "price").select(r("mad").alias("mad"))


@query(
    "a12_vector_angle",
    f"""SELECT vec_id, {sql_round('sqrt(list_dot_product(v, v))')} AS norm, {sql_round('acos(list_dot_product(v, w)/sqrt(list_dot_product(v,v))/sqrt(list_dot_product(w,w)))')} AS angle
    FROM (SELECT vec_id, embedding::DOUBLE[] AS v, list_reverse(embedding)::DOUBLE[] AS w FROM embeddings)""",
)
def a12(spark, d):
    """Length of each vector and its angle to its own mirror image."""
    v, mirrored = F.col("embedding"), F.reverse("embedding")
    return table(spark, d, "embeddings").select("vec_id", r(maths.norm(v)).alias("norm"), r(maths.angle(v, mirrored)).alias("angle"))


@query("a13_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def a13(spark, d):
    return table(spark, d, "part").select("p_brand", "p_type").distinct()


@query(
    "a14_impurity",
    f"""WITH c AS (SELECT p_brand, p_type, count(*) AS c FROM part GROUP BY 1, 2),
    p AS (SELECT p_brand, c / sum(c) OVER (PARTITION BY p_brand) AS p FROM c)
    SELECT p_brand, {sql_round('-sum(p*log2(p))')} AS entropy, {sql_round('1-sum(p*p)')} AS gini, {sql_round('1-max(p)')} AS error FROM p GROUP BY 1""",
)
def a14(spark, d):
    out = stats.impurity(table(spark, d, "part"), "p_brand", "p_type")
    return out.select("p_brand", r("entropy").alias("entropy"), r("gini").alias("gini"), r("error").alias("error"))


# ---- order, limits, unions ----------------------------------------------------------


@query(
    "o1_running_sum",
    f"SELECT o_orderkey, {sql_round('sum(o_totalprice) OVER (ORDER BY o_orderkey)', 2)} AS running FROM orders",
)
def o1(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    out = running_totals(rows, ["o_orderkey"], {"running": F.col("o_totalprice")})
    return out.select("o_orderkey", r("running", 2).alias("running"))


@query("o2_normalise", f"SELECT o_orderkey, {sql_round('o_totalprice / sum(o_totalprice) OVER ()', 12)} AS share FROM orders")
def o2(spark, d):
    return stats.normalised(table(spark, d, "orders"), "o_totalprice", "share").select("o_orderkey", r("share", 12).alias("share"))


@query(
    "o3_sort_permutation",
    "SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS pos, o_orderkey, o_totalprice FROM orders",
)
def o3(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ordered_rank(rows, [F.desc("o_totalprice"), "o_orderkey"], "pos")


@query("o4_sort_within_group", "SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS pos FROM customer")
def o4(spark, d):
    rows = table(spark, d, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return stats.sorted_within(rows, "c_mktsegment", ["c_acctbal", "c_custkey"]).drop("c_acctbal")


@query(
    "o5_top_k",
    f"""SELECT flag, id, price, rank FROM (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY price DESC, id) AS rank FROM {SQL_LINES}) WHERE rank <= 5""",
)
def o5(spark, d):
    rows = lines(spark, d).select("flag", "id", "price")
    return stats.top_k(rows, ["flag"], [F.desc("price"), F.asc("id")], 5).select("flag", "id", "price", big("rank").alias("rank"))


@query(
    "o6_row_union",
    "SELECT c_custkey AS id, c_acctbal AS balance, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier",
)
def o6(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.lit("customer").alias("kind"))
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"))
    return customers.unionByName(suppliers)
