"""Text queries: cleaning, tokens, vocabulary, term weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.functions import text as tx
from loomstat.operators import sampling, vectorize
from loomstat.operators.batches import evened
from loomstat.operators.ordering import ordered_rank
from loomstat.plans.registry import big, query, r, sql_hash, sql_round
from loomstat.session import written
from loomstat.sources.tables import table

_PLAIN = rf"regexp_replace(text, '{tx.MARKUP}', '', 'g')"
_EMO = rf"regexp_extract_all({_PLAIN}, '{tx.EMOTICON}')"


def _sql_words(text: str) -> str:
    return rf"regexp_replace(lower({text}), '{tx.NON_WORD}', ' ', 'g')"


_NOSELESS = f"array_to_string(list_transform({_EMO}, lambda e: replace(e, '-', '')), ' ')"
_CLEAN = f"trim(strip_accents({_sql_words(_PLAIN)} || ' ' || {_NOSELESS}))"


def _sql_tokens(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda t: t <> '')"


_CLEAN_TOKENS = _sql_tokens(_CLEAN)
_WORD_TOKENS = _sql_tokens(_sql_words("text"))
_STOP_LIST = "(" + ", ".join(f"'{w}'" for w in tx.STOP_WORDS) + ")"
_KEPT_TOKENS = f"list_filter({_WORD_TOKENS}, lambda t: t NOT IN {_STOP_LIST})"


def documents(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


def pages(spark, d):
    """Web pages hold markup, so the cleaner has something to do."""
    return table(spark, d, "pages").select("page_id", F.col("html").alias("text"))


_SQL_PAGES = "(SELECT page_id, html AS text FROM pages)"


@query("t1_strip_markup", f"SELECT page_id, md5({_PLAIN}) AS plain FROM {_SQL_PAGES}")
def t1(spark, d):
    return pages(spark, d).select("page_id", F.md5(tx.strip_markup(F.col("text"))).alias("plain"))


_SMILEYS = "(SELECT conv_id, turn, text || CASE turn % 4 WHEN 0 THEN ' :-)' WHEN 1 THEN ' =D ;-(' WHEN 2 THEN ' :P' ELSE '' END AS text FROM conversations)"


def smileys(spark, d):
    """Conversation turns with emoticons added by rule."""
    faces = F.when(F.col("turn") % 4 == 0, " :-)").when(F.col("turn") % 4 == 1, " =D ;-(").when(F.col("turn") % 4 == 2, " :P").otherwise("")
    return table(spark, d, "conversations").select("conv_id", "turn", F.concat("text", faces).alias("text"))


@query("t2_emoticons", rf"SELECT conv_id, turn, array_to_string(regexp_extract_all(text, '{tx.EMOTICON}'), ' ') AS found FROM {_SMILEYS}")
def t2(spark, d):
    return smileys(spark, d).select("conv_id", "turn", F.array_join(tx.emoticons(F.col("text")), " ").alias("found"))


@query("t3_words_only", f"SELECT doc_id, {_sql_words('text')} AS words FROM documents")
def t3(spark, d):
    return documents(spark, d).select("doc_id", tx.words_only(F.col("text")).alias("words"))


@query("t4_append_emoticons", f"SELECT conv_id, turn, {_sql_words(_PLAIN)} || ' ' || {_NOSELESS} AS text FROM {_SMILEYS}")
def t4(spark, d):
    plain = tx.strip_markup(F.col("text"))
    return smileys(spark, d).select("conv_id", "turn", tx.append_emoticons(tx.words_only(plain), tx.emoticons(plain)).alias("text"))


@query("t5_strip_accents", "SELECT doc_id, trim(strip_accents(text)) AS text FROM documents")
def t5(spark, d):
    return documents(spark, d).select("doc_id", F.trim(tx.strip_accents(F.col("text"))).alias("text"))


@query(
    "t6_clean",
    f"""SELECT 'd' || doc_id AS id, {_CLEAN} AS text FROM documents UNION ALL SELECT 'p' || page_id, {_CLEAN} FROM {_SQL_PAGES}
    UNION ALL SELECT 'c' || conv_id || '-' || turn, {_CLEAN} FROM {_SMILEYS}""",
)
def t6(spark, d):
    """The whole cleaner on documents, pages and conversations."""
    rows = (
        documents(spark, d).select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
        .unionByName(pages(spark, d).select(F.concat(F.lit("p"), "page_id").alias("id"), "text"))
        .unionByName(smileys(spark, d).select(F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), "text"))
    )
    return rows.select("id", tx.clean(F.col("text")).alias("text"))


@query("t7_white_space_tokens", f"SELECT doc_id, CAST(len({_sql_tokens('text')}) AS BIGINT) AS n, md5(array_to_string({_sql_tokens('text')}, '|')) AS tokens FROM documents")
def t7(spark, d):
    split = documents(spark, d).select("doc_id", tx.tokens(F.col("text")).alias("t"))
    return split.select("doc_id", big(F.size("t")).alias("n"), F.md5(F.array_join("t", "|")).alias("tokens"))


@query("t8_word_tokens", f"SELECT doc_id, CAST(len({_KEPT_TOKENS}) AS BIGINT) AS n, md5(array_to_string({_KEPT_TOKENS}, ' ')) AS tokens FROM documents")
def t8(spark, d):
    """Word tokens without stop words."""
    kept = documents(spark, d).select("doc_id", tx.without_stop_words(tx.word_tokens(F.col("text"))).alias("t"))
    return kept.select("doc_id", big(F.size("t")).alias("n"), F.md5(F.array_join("t", " ")).alias("tokens"))


@query(
    "j6_exclude_tokens",
    f"""SELECT term, count(*) AS n FROM (SELECT unnest({_WORD_TOKENS}) AS term FROM documents) t
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT unnest({_sql_tokens(_sql_words('text'))}) AS w FROM benchmark) b WHERE b.w = t.term) GROUP BY 1""",
)
def j6(spark, d):
    """Document terms that no benchmark passage uses (anti-join on term totals)."""
    totals = vectorize.term_totals(documents(spark, d), tx.word_tokens(F.col("text"))).select("term", F.col("cf").alias("n"))
    known = table(spark, d, "benchmark").select(F.explode(tx.word_tokens(F.col("text"))).alias("term")).distinct()
    return totals.join(known, "term", "left_anti")


@query("t9_stem_counts")
def t9(spark, d):
    return vectorize.stem_counts(documents(spark, d), tx.word_tokens(F.col("text")))


def word_counts(spark, d):
    return vectorize.term_counts(documents(spark, d), "doc_id", tx.word_tokens(F.col("text")))


_COUNTS = f"(SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_WORD_TOKENS}) AS term FROM documents) GROUP BY 1, 2)"
_VOCAB = f"(SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {_COUNTS} GROUP BY 1)"


@query("t10_vocabulary", f"SELECT term, df, cf, row_number() OVER (ORDER BY term) - 1 AS idx FROM {_VOCAB}")
def t10(spark, d):
    return vectorize.vocabulary(vectorize.term_totals(documents(spark, d), tx.word_tokens(F.col("text"))))


@query("t11_term_counts", f"SELECT doc_id, term, tf FROM {_COUNTS}")
def t11(spark, d):
    return word_counts(spark, d)


@query("t12_terms_of_row", f"SELECT doc_id, string_agg(term, ' ' ORDER BY term) AS terms FROM {_COUNTS} GROUP BY 1")
def t12(spark, d):
    terms = word_counts(spark, d).groupBy("doc_id").agg(F.sort_array(F.collect_list("term")).alias("t"))
    return terms.select("doc_id", F.array_join("t", " ").alias("terms"))


_KEPT_COUNTS = f"(SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_KEPT_TOKENS}) AS term FROM documents) GROUP BY 1, 2)"


@query(
    "t13_pruned_vocabulary",
    f"""WITH v AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {_KEPT_COUNTS} GROUP BY 1),
    k AS (SELECT * FROM v WHERE df <= 0.1 * (SELECT count(*) FROM documents) ORDER BY cf DESC, term LIMIT 5000)
    SELECT term, df, cf, row_number() OVER (ORDER BY term) - 1 AS idx FROM k""",
)
def t13(spark, d):
    """Stop words and terms of more than a tenth of the documents out, the 5000 most frequent kept."""
    return pruned(spark, d)


def pruned(spark, d, max_features: int = 5000):
    docs = evened(documents(spark, d))
    totals = vectorize.term_totals(docs, tx.word_tokens(F.col("text")))
    totals = totals.where(~F.col("term").isin(list(tx.STOP_WORDS)))  # once a term, not once a token
    return vectorize.pruned_vocabulary(totals, docs.agg(F.count(F.lit(1))).scalar(), max_df=0.1, max_features=max_features)


_IDF = "ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0"


@query("t14_smooth_idf", f"SELECT term, df, {sql_round(_IDF, 9)} AS idf FROM {_VOCAB}")
def t14(spark, d):
    fit = vectorize.fit_tfidf(documents(spark, d), tx.word_tokens(F.col("text")))
    return fit.terms.select("term", "df", r("idf", 9).alias("idf"))


@query(
    "t15_unit_rows",
    f"SELECT doc_id, term, {sql_round('tf / greatest(sqrt(sum(tf * tf) OVER (PARTITION BY doc_id)), 2.220446049250313e-16)', 9)} AS weight FROM {_COUNTS}",
)
def t15(spark, d):
    rows = vectorize.l2_normalised(word_counts(spark, d).withColumn("weight", F.col("tf").cast("double")), "doc_id", "weight")
    return rows.select("doc_id", "term", r("weight", 9).alias("weight"))


def _sql_tfidf(counts: str, fit_counts: str, documents_sql: str) -> str:
    return f"""WITH c AS {counts}, v AS (SELECT term, ln((1.0 + {documents_sql}) / (1.0 + count(*))) + 1.0 AS idf FROM {fit_counts} GROUP BY 1),
    w AS (SELECT doc_id, term, tf * idf AS w FROM c JOIN v USING (term))
    SELECT doc_id, term, {sql_round('w / greatest(sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 2.220446049250313e-16)', 9)} AS weight FROM w"""


@query("t16_tfidf", _sql_tfidf(_KEPT_COUNTS, _KEPT_COUNTS, "(SELECT count(*) FROM documents)"))
def t16(spark, d):
    """TF-IDF of all documents, stop words left out."""
    docs = documents(spark, d)
    words = tx.without_stop_words(tx.word_tokens(F.col("text")))
    counts = written(vectorize.term_counts(docs, "doc_id", words))  # totals and weights from one look at the texts
    return vectorize.fit_tfidf(docs, counts=counts).transform(counts, "doc_id").select("doc_id", "term", r("weight", 9).alias("weight"))


_SPLIT_DOCS = f"(SELECT doc_id, text, row_number() OVER (ORDER BY {sql_hash(3, 'doc_id')}) <= floor(0.2 * count(*) OVER ()) AS is_test FROM documents)"


def _sql_side(is_test: str) -> str:
    return f"(SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_WORD_TOKENS}) AS term FROM {_SPLIT_DOCS} WHERE {is_test}) GROUP BY 1, 2)"


@query("t17_tfidf_unseen", _sql_tfidf(_sql_side("is_test"), _sql_side("NOT is_test"), f"(SELECT count(*) FROM {_SPLIT_DOCS} WHERE NOT is_test)"))
def t17(spark, d):
    """Weights of held-out documents under the vocabulary of the others."""
    docs = written(sampling.random_split(evened(documents(spark, d)), "doc_id", 0.2, seed=3))  # read by every step below
    train, test = docs.where(~F.col("is_test")), docs.where("is_test")
    words = tx.word_tokens(F.col("text"))
    fit = vectorize.fit_tfidf(train, words)
    return fit.transform(vectorize.term_counts(test, "doc_id", words), "doc_id").select("doc_id", "term", r("weight", 9).alias("weight"))


@query(
    "s3_text_by_position",
    "SELECT doc_id, md5(text) AS text_md5 FROM (SELECT *, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rn FROM documents) WHERE rn <= floor(0.2 * (SELECT count(*) FROM documents))",
)
def by_position(spark, d):
    """The longest fifth of the documents, as positions in a sorted table."""
    ranked = ordered_rank(table(spark, d, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), "doc_id"], "rn", with_total=True)
    head = ranked.where(F.col("rn") <= F.floor(F.lit(0.2) * F.col("rn_total"))).select("doc_id")
    return table(spark, d, "documents").join(head, "doc_id").select("doc_id", F.md5("text").alias("text_md5"))
