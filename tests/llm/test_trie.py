"""Conversation prefix trie against a dictionary of prefixes, over one and over many shards."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.llm import prefix_trie, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, kind string, near int, depth int, chars int, ids int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", "part", 1, 2, 3, 4) for r in rows], SCHEMA)


def grafted(rows):
    return prefix_trie.grafted(rows, F.col("conv_id") - F.col("conv_id") % 100, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6, most=5)


def name(turn):
    return hashlib.sha256(f"{len(turn[0])}:{turn[0]}{turn[1]}".encode()).digest()


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, name((r or "", x or "")), (r or "", x or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(m) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, m in members.items():
        ends = sorted(c for c in m if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), len(kids[node]), leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, convs=300):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-250, 1500), convs):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant"]), "hot" if t == 0 and rng.random() < 0.7 else rng.choice(["a", "b", "é日", ""])))
    return rows


def odd():
    rows = [(None, 0, "user", "x"), (None, None, None, None), (7, None, None, None), (7, 1, "user", None), (7, 1, "user", None), (7, 1, "a", "b"), (8, 3, "u\x00", "t"), (8, 3, "u", "\x00t")]
    rows += [(100 + i, t, "user", f"w{t}") for i in range(60) for t in range(3)]  # one very common conversation
    rows += [(300 + i, t, "user", f"d{t}") for i in (0, 1, 2, 6) for t in range(150 + 40 * i)]  # deep ones, beyond a block of columns
    return rows + [(9, 0, "user", "y" * 300_000)]


@pytest.mark.parametrize("rows", [made(1), made(2, 40), odd(), [(5, 0, "user", "x")]], ids=["mixed", "few", "odd", "one"])
@pytest.mark.parametrize("per_shard", [10**6, 25])
def test_equals_brute_force(spark, monkeypatch, rows, per_shard):
    monkeypatch.setattr(prefix_trie, "TURNS_PER_SHARD", per_shard)
    monkeypatch.setattr(prefix_trie, "BROADCAST_ROWS", 0 if per_shard == 25 else 10**6)
    monkeypatch.setattr(prefix_trie, "LEAST_TURNS", 10**9)
    found = prefix_trie.prefix_trie(grafted(frame(spark, rows))).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows)


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert sorted((tuple(r) for r in queries.QUERIES["op13_prefix_trie"](spark, folder).collect()), key=repr) == brute(rows)


def test_no_conversations(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        found = prefix_trie.prefix_trie(grafted(frame(spark, rows)))
        assert found.collect() == [] and found.columns == [c.split()[0] for c in prefix_trie.OUT.split(", ")]


def test_turnless_conversations_belong_to_the_root(spark):
    lost = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 2)  # its base does not exist and it has fewer turns than h
    found = prefix_trie.prefix_trie(grafted(frame(spark, [(lost, 0, "user", "x")]))).collect()
    assert [tuple(r) for r in found] == [(lost, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lost).encode()).hexdigest())]


def test_digest_of_ids_over_many_chunks(spark):
    ids = list(range(0, 50_000, 3))
    chunks = [(b"k", ids[i], ",".join(map(str, ids[i : i + 700]))) for i in range(0, len(ids), 700)]
    random.Random(0).shuffle(chunks)
    table = spark.createDataFrame(chunks + [(b"j", 1, "1")], "key binary, conv_id long, ids string").repartition(5)
    got = {bytes(r.key): bytes(r.ends).hex() for r in prefix_trie._digests(table).collect()}
    assert got == {b"k": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"j": hashlib.sha256(b"1").hexdigest()}


def test_rows_are_sorted_in_blocks():
    rng = np.random.default_rng(5)
    lists = [rng.integers(0, 2, rng.choice([0, 3, 31, 32, 33, 64, 90])) for _ in range(200)] + [np.zeros(n, int) for n in (32, 64, 100, 100, 0)]
    lists += [np.append(np.zeros(99, int), k) for k in (1, 0, 1)]
    sizes, conv = np.array([len(x) for x in lists]), rng.permutation(len(lists))
    starts = np.cumsum(sizes) - sizes
    order = prefix_trie.sorted_rows(np.concatenate(lists), starts, sizes, conv)
    keys = [(lists[i].tolist(), conv[i]) for i in order]
    assert keys == sorted(keys)
