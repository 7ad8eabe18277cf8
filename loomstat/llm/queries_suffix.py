"""The query of the repeated byte windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.llm import suffix_dedup
from loomstat.llm.expr import documents
from loomstat.llm.registry import query


@query("op1_suffix_dedup")
def op1(spark, sf_dir):
    found = suffix_dedup.with_counts(suffix_dedup.remove_repeats(documents(spark, sf_dir)))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
