"""The query of the embedding whitening."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.llm import whitening
from loomstat.llm.registry import query


@query("op12_embedding_whitening")
def op12(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")
    found = whitening.whiten(vectors, whitening.fit(vectors))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
