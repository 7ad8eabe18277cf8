"""Queries of the learnt models, the secret scan and the decontamination."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.llm import decontaminate, language_id, quality_model, secrets
from loomstat.llm.expr import documents, sha256
from loomstat.llm.registry import query


def _share(docs, parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")) % parts


@query("op3_decontamination")
def op3(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.find(documents(spark, sf_dir), benchmark)


@query("op6_secrets")
def op6(spark, sf_dir):
    found = secrets.find(documents(spark, sf_dir))

    def is_kind(kind):
        return lambda s: s["kind"] == kind

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    counts = [F.size(F.filter("spans", is_kind(k))).cast("bigint").alias(f"n_{k}") for k in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *counts, sha256(told(base)).alias("base_sha256"), told(F.col("spans")).alias("spans"))


@query("op7_language_id")
def op7(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs, _share(docs, 5) != 0)
    found = language_id.predict(docs, model)
    return found.select("doc_id", (_share(found, 5) == 0).alias("held_out"), "lang_pred", "score")


@query("op8_quality_model")
def op8(spark, sf_dir):
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    weights = quality_model.fit(docs, labels, _share(labels, 4) != 2)
    found = quality_model.score(docs, weights)
    return found.select("doc_id", (_share(found, 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
