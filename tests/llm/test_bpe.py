import hashlib
import itertools

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from loomstat.llm import bpe, queries
from loomstat.llm.queries_bpe import RANK_FILE
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, odd_texts

RANKS = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["<|endoftext|> it's 'S we'll’ve", "a\x1c\x1d\x85  b  c\n\n d\t", "½ ² Ⅷ ٣ 12345678", "👩‍👩‍👧 é ‍", "\r\n \r\n x", "_a_b__c '''s"]


@settings(max_examples=300, deadline=None)
@given(st.text(min_size=1, max_size=40))
def test_merges_agree_with_the_library(text):
    raw = text.encode()
    assert bpe.merge(raw, RANKS) == LIBRARY._encode_single_piece(raw)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, " " * 4000, "日本語" * 700, "thequickbrown" * 300])
def test_long_pieces(text):
    assert bpe.merge(text.encode(), RANKS) == LIBRARY._encode_single_piece(text.encode())


@pytest.mark.parametrize("block_chars", [50, 8_000_000])
def test_round_trip(spark, block_chars):
    texts = odd_texts() + [(100 + i, t) for i, t in enumerate(ODD)] + [(100, ODD[0])]
    out = bpe.decode(bpe.encode(documents(spark, texts), RANKS, public_tokenizers.PATTERN, block_chars=block_chars), RANKS)
    got = sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in out.collect()), key=str)
    assert got == sorted(((i, LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for i, t in texts), key=str)


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(documents(spark, []), RANKS, public_tokenizers.PATTERN), RANKS).collect() == []


def test_ids_of_any_type(spark):
    docs = documents(spark, [(1, "some text"), (2, None)]).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert {r.doc_id: len(r.ids) > 0 for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()} == {"d1": True, "d2": False}


def test_text_is_cut_once(spark):
    docs = documents(spark, odd_texts())
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    encoded.collect()
    assert "ReusedExchange" in encoded._jdf.queryExecution().executedPlan().toString()


def test_query_on_the_smallest_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in docs:
        ids = LIBRARY.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    assert sorted(map(tuple, queries.QUERIES["op10_bpe"](spark, "/root/testdata/sf0.001").collect())) == sorted(want)


def test_gather():
    import numpy as np

    starts, sizes = np.array([5, 0, 9]), np.array([2, 0, 3])
    assert bpe.gather(starts, sizes).tolist() == list(itertools.chain(range(5, 7), range(9, 12)))
