import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from loomstat.llm import queries, simhash
from loomstat.llm.graph import components
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, odd_texts, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return []
    return [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or [" ".join(w)]


def fingerprint(text, words=3):
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, words)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute_groups(texts):
    fps = [fingerprint(t) for _, t in texts]
    sets = Sets(set(fps))
    for a in set(fps):
        for b in set(fps):
            if a < b and (a ^ b).bit_count() <= 2:
                sets.join(a, b)
    least = {}
    for (i, _), f in zip(texts, fps, strict=True):
        if i is not None:
            least[sets.find(f)] = min(i, least.get(sets.find(f), i))
    return Counter((i, f, least.get(sets.find(f))) for (i, _), f in zip(texts, fps, strict=True))


def test_groups_of_odd_texts(spark):
    found = simhash.groups(simhash.fingerprints(documents(spark, odd_texts()), words=3)).collect()
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in found) == brute_groups(odd_texts())


def test_query_on_the_smallest_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    found = queries.QUERIES["op2_simhash"](spark, "/root/testdata/sf0.001").collect()
    assert Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in found) == brute_groups([(r.doc_id, r.text) for r in docs])


@pytest.mark.parametrize(("budget", "node_rows"), [(0, 5000), (2, 5000), (2, 20)])
def test_links_are_all_close_pairs_once(spark, budget, node_rows):
    rng = np.random.default_rng(budget)
    centres = rng.integers(0, 2**64, 6, dtype=np.uint64)
    values = set(centres.tolist()) | {0, 2**64 - 1, 1, 2**63}
    for _ in range(250):
        x = int(rng.choice(centres))
        for b in rng.integers(0, 64, int(rng.integers(1, 4))):
            x ^= 1 << int(b)
        values.add(x)
    frame = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp bigint")
    got = Counter(frozenset((r.u % 2**64, r.v % 2**64)) for r in simhash.links(frame, budget, node_rows).collect())
    want = {frozenset((a, b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= budget}
    assert set(got) == want
    assert set(got.values()) <= {1}


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 2000 + i) for i in range(50)]
    sets = Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: sets.find(x) for a, b in edges if a != b for x in (a, b)}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_empty_table(spark):
    assert simhash.groups(simhash.fingerprints(documents(spark, []), words=3)).collect() == []


def test_hot_copies_keep_their_component(spark):
    fps = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") * 1048576).alias("fp"))
    found = {r.doc_id: r.component_id for r in simhash.groups(fps).collect()}
    assert all(found[i] == 0 for i in range(0, 3000, 3))
