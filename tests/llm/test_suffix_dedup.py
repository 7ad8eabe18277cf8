import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from loomstat.llm import queries, suffix_dedup
from loomstat.llm.windows import sliding, window_hashes, words_at_every_byte

from tests.llm.fixtures import documents, odd_texts

LAST = 2**63


def brute(texts, width=50):
    """What is left of every row, by looking up each window."""
    first = {}
    coded = [(LAST if i is None else i, (t or "").encode()) for i, t in texts]
    for i, b in coded:
        for j in range(len(b) - width + 1):
            w = b[j : j + width]
            first[w] = min(first.get(w, LAST + 1), i)
    out = []
    for i, b in coded:
        gone = bytearray(len(b))
        for j in range(len(b) - width + 1):
            if first[b[j : j + width]] < i:
                gone[j : j + width] = b"\1" * width
        spans = [j for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1])]
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((None if i == LAST else i, len(b), sum(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digest(found):
    rows = suffix_dedup.with_counts(found).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows), key=str)


@pytest.mark.parametrize("block_bytes", [300, 100_000])
def test_odd_texts(spark, block_bytes):
    texts = odd_texts()
    found = suffix_dedup.remove_repeats(documents(spark, texts), block_bytes=block_bytes)
    assert digest(found) == brute(texts)


def test_spans_are_what_is_missing(spark):
    texts = odd_texts()
    for r in suffix_dedup.remove_repeats(documents(spark, texts)).collect():
        if r.doc_id is None or r.doc_id == 6:
            continue
        raw = (dict(texts)[r.doc_id] or "").encode()
        left, at = b"", 0
        for s in r.spans:
            left, at = left + raw[at : s.start], s.end
        assert left + raw[at:] == bytes(r.kept)


def test_passages_at_edges_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 64)
    monkeypatch.setattr(suffix_dedup, "_POWERS", {})
    rng = np.random.default_rng(3)
    part = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    shared = [part(n) for n in (49, 50, 51, 80, 200)]
    texts = [(i, part(int(rng.integers(0, 60))) + shared[i % 5][: 200 - i] + part(int(rng.integers(0, 60))) + shared[(i * 3) % 5]) for i in range(40)]
    assert digest(suffix_dedup.remove_repeats(documents(spark, texts), block_bytes=500)) == brute(texts)


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(documents(spark, [])).collect() == []


def test_too_small_a_threshold(spark):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(documents(spark, []), threshold=8)


def test_query_on_the_smallest_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = sorted((tuple(r) for r in queries.QUERIES["op1_suffix_dedup"](spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs])


@settings(max_examples=30, deadline=None)
@given(st.binary(min_size=0, max_size=300), st.integers(8, 40))
def test_equal_windows_have_equal_hashes(raw, width):
    buf = np.frombuffer(raw, np.uint8)
    hashed = window_hashes(words_at_every_byte(buf), width)
    windows = [raw[i : i + width] for i in range(len(raw) - width + 1)]
    assert len(hashed) == len(windows)
    assert len(set(hashed.tolist())) == len(set(windows))
    assert len(set(zip(hashed.tolist(), windows, strict=True))) == len(set(windows))


@given(st.lists(st.integers(0, 99), max_size=60), st.integers(1, 20))
def test_sliding_minimum(values, width):
    got = sliding(np.minimum, np.array(values, np.int64), width)
    assert got.tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]
