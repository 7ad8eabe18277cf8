"""Texts to term weights, as long tables (doc, term, value).

The matrix documents x terms is never made dense.  Term totals are summed per
task before they are shuffled, and frequent terms are salted in joins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from loomstat.operators.batches import parts_for
from loomstat.operators.joins import PART_ROWS, salted_join
from loomstat.operators.ordering import ordered_rank
from loomstat.session import cut_lineage

PART_BYTES, SLICE_TOKENS = 8 << 20, 1 << 18  # text of one part, tokens counted at a time
EPSILON = 2.220446049250313e-16  # machine epsilon: the floor of a row's norm


def _bytes(df: DataFrame) -> int:
    """Bytes of all strings, and of arrays of words at eight a word."""
    sizes = [F.octet_length(c.name) for c in df.schema if isinstance(c.dataType, StringType)]
    sizes += [F.greatest(F.size(c.name), F.lit(0)) * 8 for c in df.schema if isinstance(c.dataType, ArrayType)]
    return df.agg(F.sum(sum((F.coalesce(s, F.lit(0)).cast("bigint") for s in sizes), F.lit(0)))).first()[0] or 0


def term_counts(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, term, tf): how often each document holds each term.

    Documents are placed by key before they are split, because a text is smaller
    than its (key, term, tf) rows.  Counting, and any later work per document,
    then stays where the document is.  There are as many parts as the texts need,
    so that a part's rows stay few however long all texts are.
    """
    placed = df.repartition(parts_for(df, _bytes(df), PART_BYTES), key)
    return placed.select(key, F.explode(tokens).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_totals(df: DataFrame, tokens: Column) -> DataFrame:
    """(term, df, cf): documents that hold a term, and how often it stands in all of them.

    Tokens are counted where their text is read, a batch of documents at a time, and
    again after one shuffle of (term, counts); the texts do not move and no token
    becomes a row.
    """

    def count(batches):
        for lists in (part for batch in batches for part in _few_tokens(batch.column(0))):
            flat = lists.flatten().dictionary_encode()
            n = len(flat.dictionary)
            if not n:
                continue
            doc = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            known = flat.indices.is_valid().to_numpy(zero_copy_only=False)
            code = pc.fill_null(flat.indices, 0).to_numpy(zero_copy_only=False).astype(np.int64)[known]
            within = np.bincount(np.unique(doc[known] * n + code) % n, minlength=n)
            yield pa.RecordBatch.from_arrays([flat.dictionary.cast(pa.string()), pa.array(within), pa.array(np.bincount(code, minlength=n))], ["term", "df", "cf"])

    counted = df.select(tokens.alias("_tokens")).mapInArrow(count, "term string, df long, cf long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _few_tokens(lists: pa.Array):
    """``lists`` cut into slices of some ``SLICE_TOKENS`` tokens, as work on them takes many times their size."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(lists):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_TOKENS, side="right")))
        yield lists.slice(start, stop - start)
        start = stop


def vocabulary(totals: DataFrame) -> DataFrame:
    """(term, df, cf, idx): document and total frequency (``term_totals``), 0-based alphabetical index."""
    ranked = ordered_rank(totals, ["term"], "_rn")
    return ranked.select("term", "df", "cf", (F.col("_rn") - 1).alias("idx"))


def pruned_vocabulary(totals: DataFrame, documents: Column, max_df: float = 1.0, max_features: int | None = None) -> DataFrame:
    """As ``vocabulary`` without the terms found in more than ``max_df`` of all documents.

    ``max_features`` keeps the most frequent terms, ties in alphabetical order.
    """
    terms = totals.where(F.col("df") <= F.lit(max_df) * documents)
    if max_features is not None:
        terms = terms.orderBy(F.desc("cf"), "term").limit(max_features)
    ranked = ordered_rank(terms, ["term"], "_rn")
    return ranked.select("term", "df", "cf", (F.col("_rn") - 1).alias("idx"))


def smooth_idf(documents: Column, df: Column) -> Column:
    return F.ln((F.lit(1.0) + documents) / (F.lit(1.0) + df)) + F.lit(1.0)


def l2_normalised(weights: DataFrame, key: str, col: str, rows: int = 0) -> DataFrame:
    """Each document's weights divided by their length; ``rows`` says how many there may be where they are not placed by ``key``."""
    parts = parts_for(weights, rows, PART_ROWS)
    if parts > weights.sparkSession.sparkContext.defaultParallelism:
        weights = weights.repartition(parts, key)
    length = F.sqrt(F.sum(F.col(col) * F.col(col)).over(Window.partitionBy(key)))
    return weights.withColumn(col, F.col(col) / F.greatest(length, F.lit(EPSILON)))


@dataclass
class TfidfFit:
    """A fitted vocabulary table (term, df, idf) and the number of documents behind it."""

    terms: DataFrame

    def transform(self, counts: DataFrame, key: str) -> DataFrame:
        """(key, term, weight); terms outside the vocabulary are left out."""
        rows = self.terms.agg(F.sum("df")).first()[0] or 0
        joined = salted_join(counts, self.terms, "term", key, "df", total=rows)
        weighted = joined.select(key, "term", (F.col("tf") * F.col("idf")).alias("weight"))
        return l2_normalised(weighted, key, "weight", rows)


def fit_tfidf(docs: DataFrame, tokens: Column | None = None, counts: DataFrame | None = None) -> TfidfFit:
    """Vocabulary and smoothed inverse document frequencies of a corpus, from its tokens or from its ``term_counts``.

    The table is written once and serves every later transform.
    """
    documents = docs.agg(F.count(F.lit(1))).scalar()
    terms = term_totals(docs, tokens).select("term", "df") if counts is None else counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return TfidfFit(cut_lineage(terms.withColumn("idf", smooth_idf(documents, F.col("df")))))


def count_vectorizer(vocab: DataFrame, tokens_col: str, out: str) -> CountVectorizerModel:
    """Model that turns token arrays into sparse count vectors over ``vocab``.

    The terms go to every task with the model, so this way is for vocabularies that
    were bounded on purpose (``max_features``); ``sparse_vectors`` has no bound.
    """
    rows = vocab.orderBy("idx").select("term").collect()
    return CountVectorizerModel.from_vocabulary([row["term"] for row in rows], inputCol=tokens_col, outputCol=out)


def _sparse(size: int, entries) -> SparseVector:
    return Vectors.sparse(size, [(e["idx"], e["weight"]) for e in entries])


def sparse_vectors(docs: DataFrame, weights: DataFrame, vocab: DataFrame, key: str, out: str = "features") -> DataFrame:
    """``docs`` with the weights (key, term, weight) as one sparse vector per document.

    Terms get their positions from a join with ``vocab`` (term, idx, df), so any number of
    terms will do; a document without known terms gets the zero vector.
    """
    size = vocab.agg(F.coalesce(F.max("idx") + 1, F.lit(0)).cast("int")).scalar()
    placed = salted_join(weights, vocab.select("term", "idx", "df"), "term", key, "df")
    entry = F.struct(F.col("idx").cast("int").alias("idx"), F.col("weight"))
    vectors = placed.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    none = F.array().cast("array<struct<idx:int,weight:double>>")
    made = F.udf(_sparse, VectorUDT(), useArrow=False)  # once per document; Spark has no expression that makes sparse vectors
    return docs.join(vectors, key, "left").withColumn(out, made(size, F.coalesce("_entries", none))).drop("_entries")


def stem_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """(stem, n, terms): word forms of one stem taken together.

    The stemmer sees each distinct term once, whatever the corpus repeats.
    """
    from loomstat.functions.stemming import english_stem

    totals = term_totals(df, tokens).select("term", "cf")

    @F.pandas_udf("string")
    def stem(terms: pd.Series) -> pd.Series:
        return terms.map(english_stem)

    return totals.withColumn("stem", stem("term")).groupBy("stem").agg(F.sum("cf").alias("n"), F.count(F.lit(1)).alias("terms"))
