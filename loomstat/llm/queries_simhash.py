"""The query of the SimHash groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.llm import simhash
from loomstat.llm.expr import documents
from loomstat.llm.registry import query
from loomstat.session import cut_lineage


@query("op2_simhash")
def op2(spark, sf_dir):
    fps = cut_lineage(simhash.fingerprints(documents(spark, sf_dir), words=3))
    found = simhash.groups(fps, budget=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
