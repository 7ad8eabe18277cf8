"""The corpus pipeline: documents in; cleaned, deduplicated, decontaminated, masked and encoded documents out.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and
returns the columns of documents; the last one returns the encoding.  Rows with a NULL
id can be told apart by no stage that joins on ids: those stages keep them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import bpe, decontaminate, quality_rules, simhash
from loomstat.llm.queries_bpe import RANK_FILE
from loomstat.llm.queries_native import mask_documents
from loomstat.session import cut_lineage, new_path


def rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failed lines; NULL and empty texts fail."""
    return quality_rules.cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (fingerprints of three-word shingles, linked at two bits), the document of smallest id.

    NULL and empty texts are copies of each other; rows that share an id stay or go together.
    """
    fingerprints = cut_lineage(simhash.fingerprints(docs, words=3))
    grouped = simhash.groups(fingerprints, budget=2).where("doc_id IS NOT NULL")
    copies = grouped.groupBy("doc_id").agg(F.max(F.col("component_id") == F.col("doc_id")).alias("first")).where("NOT first")
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage or re-parameterised question of the benchmark; NULL and empty texts have none and stay."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontaminate.find(docs, benchmark).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; NULL and empty texts stay as they are."""
    return mask_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the token ids and the text decoded from them; NULL and empty texts have no tokens."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("quality rules", rule_filter),
    ("near dedup", near_dedup),
    ("decontamination", drop_contaminated),
    ("pii", mask_pii),
    ("bpe", encode),
]
#: SQL cannot state the near-copy search and the tokenizer; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
