"""The query of the tokenizer."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from loomstat.llm import bpe
from loomstat.llm.expr import documents, sha256
from loomstat.llm.registry import query

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def encoded_and_decoded(docs):
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    return bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)


@query("op10_bpe")
def op10(spark, sf_dir):
    return encoded_and_decoded(documents(spark, sf_dir)).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
