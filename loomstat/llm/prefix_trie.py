"""Conversation prefix trie: which conversations begin with the same turns, and what sharing them would save.

A turn is named by the SHA-256 of its role and text; a conversation is the list of its
turns' names.  Conversations are dealt into range shards of that order (turn names, then
id), so the members of a node (a distinct sequence of first turns) lie side by side, in one
shard or in neighbouring ones.  A shard numbers its turns, fills padded matrices of turn
numbers (``WIDTH`` columns at a time) and sorts them by numpy's lexsort.  Column change
masks, OR-accumulated from the left, mark where nodes start; reduceat aggregates a depth at
once.  Only nodes on the path of a shard's first or last row can go on in another shard:
these leave as parts, under a key chained from their turns' names, and are recombined by
key; their subtree sums come from ``log2(depth)`` rounds of pointer doubling.

Hot turns and prefixes need no special care, as a range cut falls anywhere among equal
sequences.  The digest of a node's own conversation ids is a hash of one ordered stream and
so serial by nature: where a node spans shards, its ids travel in packed chunks, and the
task that hashes them holds one chunk at a time.

Turns go by number, NULL first, ties by their SHA-256; NULL roles and texts are empty.
Rows with a NULL conversation id have no conversation and are left out; repeated rows are
turns of their own.  A conversation's turn names must fit a row.  An empty table has no
nodes, not even the root.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.session import cut_lineage

WIDTH = 32
TURNS_PER_SHARD, LEAST_TURNS = 200_000, 5_000
IDS_PER_CHUNK, ROWS_PER_BATCH = 10_000, 20_000
BROADCAST_ROWS = 50_000
ROOT = hashlib.sha256(b"").digest()
OUT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"

_NAMES = ["kind", "conv_id", "depth", "parent_conv_id", "key", "parent_key", "n_convs", "n_children", "n_leaves", "saved", "chars", "ends", "ids"]
_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 5, pa.binary(), pa.string()]
_SCHEMA = ", ".join(f"{n} {'string' if t == pa.string() else 'binary' if t == pa.binary() else 'long'}" for n, t in zip(_NAMES, _TYPES))


# ---- conversations as lists of turns --------------------------------------


def turn_lists(rows: DataFrame, near: Column | None = None) -> DataFrame:
    """(conv_id, near, turns): each conversation's turns in order, as structs of name and code points.

    ``near`` is a column that depends on conv_id only; rows are dealt by it, so that a
    join on it finds them in place.
    """
    role, text = (F.coalesce(rows[c].cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    conv = rows["conv_id"].cast("bigint")
    named = rows.where(conv.isNotNull()).select(
        conv.alias("conv_id"), (conv if near is None else near).alias("near"), F.struct(rows["turn"].alias("turn"), name.alias("name"), F.length(text).alias("chars")).alias("t")
    )
    lists = named.repartition("near").groupBy("near", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", "near", F.transform("t", lambda t: F.struct(t["name"].alias("name"), t["chars"].alias("chars"))).alias("turns"))


def grafted(rows: DataFrame, base: Column, shared: Column, most: int) -> DataFrame:
    """(conv_id, turns): the first ``shared`` turns (``most`` at most) of conversation ``base``, then the own turns after as many."""
    lists = turn_lists(rows, near=base)
    heads = lists.where("conv_id = near").select("near", F.slice("turns", 1, most).alias("head"))
    h = F.least(shared, F.lit(most)).cast("int")
    first = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    return lists.join(heads, "near", "left").select("conv_id", F.concat(first, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


# ---- one shard ------------------------------------------------------------


def padded(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray, column: int) -> np.ndarray:
    """The turn numbers of ``rows`` in ``WIDTH`` columns from ``column`` on, -1 behind the last turn."""
    at = np.arange(column, column + WIDTH)
    inside = at < sizes[rows][:, None]
    out = np.full((len(rows), WIDTH), -1, codes.dtype)
    out[inside] = codes[(starts[rows][:, None] + at)[inside]]
    return out


def sorted_rows(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Rows ordered by turn numbers, shorter first, then by id: a lexsort per block of columns, of rows still tied."""
    rank, tied, column = np.zeros(len(conv), np.int64), np.arange(len(conv)), 0
    while len(tied):
        block = padded(codes, starts, sizes, tied, column)
        order = np.lexsort([*block.T[::-1], rank[tied]])
        tied, block = tied[order], block[order]
        before = rank[tied]
        fresh = np.ones(len(tied), bool)
        fresh[1:] = (before[1:] != before[:-1]) | (block[1:] != block[:-1]).any(1)
        top = np.flatnonzero(np.append(True, before[1:] != before[:-1]))  # where the groups of the block before begin
        first = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        base = top[np.searchsorted(top, first, side="right") - 1]
        rank[tied] = (before[first] + first - base)[group]
        column += WIDTH
        open_ = np.bincount(group)[group] > 1
        longer = np.maximum.reduceat(sizes[tied], first)[group] > column
        tied = tied[open_ & longer]
    return np.lexsort([conv, rank])


def levels(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, conv: np.ndarray) -> Iterator[dict]:
    """Per depth, the nodes of sorted rows: first row, members, smallest id, members that end there, parent's place above."""
    n = len(conv)
    yield {"row": np.zeros(1, np.int64), "n": np.array([n]), "least": conv.min(keepdims=True), "ends": np.array([(sizes == 0).sum()]), "up": np.zeros(1, np.int64)}
    rows, above = np.arange(n), np.zeros(1, np.int64)
    mask = np.zeros(n, bool)
    mask[0] = True
    for depth in range(1, int(sizes.max()) + 1):
        column = (depth - 1) % WIDTH
        if column == 0:
            block = padded(codes, starts, sizes, rows, depth - 1)
        mask[1:] |= block[1:, column] != block[:-1, column]
        deep = sizes[rows] >= depth
        cut = np.flatnonzero(mask)
        full = deep[cut]
        at = rows[cut[full]]
        yield {
            "row": at,
            "n": np.diff(np.append(cut, len(rows)))[full],
            "least": np.minimum.reduceat(conv[rows], cut)[full],
            "ends": np.add.reduceat((sizes[rows] == depth).astype(np.int64), cut)[full],
            "up": np.searchsorted(above, at, side="right") - 1,
        }
        above = at
        kept = np.flatnonzero(deep)
        if 2 * len(kept) < len(rows):  # go on with the rows that are deep enough; changes between them add up
            mask = np.logical_or.reduceat(mask[: kept[-1] + 1], np.append(0, kept[:-1] + 1))
            rows, block = rows[kept], block[kept]


def _hash_of(ids: np.ndarray) -> bytes:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).digest()


def _chain(names: list[bytes]) -> list[bytes]:
    """The keys of all prefixes of a list of turn names, the empty one first."""
    out = [ROOT]
    for name in names:
        out.append(hashlib.sha256(out[-1] + name).digest())
    return out


def shard_rows(conv: np.ndarray, turns: pa.ListArray) -> Iterator[dict]:
    """Columns of the nodes of one shard: whole ones (``node``), pieces of others (``part``) and ids ending in those (``ends``)."""
    sizes = pc.list_value_length(turns).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = turns.flatten()
    coded = flat.field("name").dictionary_encode()
    rank = np.empty(len(coded.dictionary), np.int64)
    rank[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
    codes, chars = rank[coded.indices.to_numpy()], flat.field("chars").to_numpy().astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    order = sorted_rows(codes, starts, sizes, conv)
    starts, sizes, conv = starts[order], sizes[order], conv[order]
    names = flat.field("name")
    first, last = (_chain(names.slice(int(starts[r]), int(sizes[r])).to_pylist()) for r in (0, -1))

    tree = list(levels(codes, starts, sizes, conv))
    below = {"leaves": np.zeros(0, np.int64), "saved": np.zeros(0, np.int64), "shared": np.zeros(0, bool), "up": np.zeros(0, np.int64)}
    for depth in range(len(tree) - 1, -1, -1):
        level = tree[depth]
        k = len(level["row"])
        shared = np.zeros(k, bool)  # on the path of the first or last row: may go on elsewhere
        shared[0] = depth < len(first) and level["row"][0] == 0
        shared[-1] |= depth < len(last)
        level["shared"], level["chars"] = shared, chars[starts[level["row"]] + depth - 1] if depth else np.zeros(1, np.int64)
        whole = ~below["shared"]
        level["children"] = np.bincount(below["up"][whole], minlength=k)
        leaves, saved = np.zeros(k, np.int64), np.zeros(k, np.int64)
        np.add.at(leaves, below["up"][whole], below["leaves"][whole])
        np.add.at(saved, below["up"][whole], below["saved"][whole])
        own = ~shared  # a shared node's own share waits until its members are known
        level["leaves"] = leaves + (own & (level["children"] == 0))
        level["saved"] = saved + np.where(own, (level["n"] - 1) * level["chars"], 0)
        below = level

    nothing = _hash_of(conv[:0])
    for depth, level in enumerate(tree):
        key_of = [None] * len(level["row"])
        if level["shared"][0] and depth < len(first) and level["row"][0] == 0:
            key_of[0] = first[depth]
        if depth < len(last):
            key_of[-1] = last[depth]
        up = tree[depth - 1] if depth else None
        for lo in range(0, len(level["row"]), ROWS_PER_BATCH):
            at = slice(lo, lo + ROWS_PER_BATCH)
            row, ends, shared = level["row"][at], level["ends"][at], level["shared"][at]
            parent_shared = up["shared"][level["up"][at]] if depth else np.zeros(len(row), bool)
            parent_key = [(first[depth - 1] if u == 0 and up["row"][0] == 0 and depth <= len(first) else last[depth - 1]) if s else None for u, s in zip(level["up"][at].tolist(), parent_shared)]
            yield {
                "kind": ["part" if s else "node" for s in shared],
                "conv_id": level["least"][at],
                "depth": np.full(len(row), depth),
                "parent_conv_id": pa.array(up["least"][level["up"][at]] if depth else np.zeros(len(row), np.int64), mask=parent_shared | (depth == 0)),
                "key": key_of[at],
                "parent_key": parent_key,
                "n_convs": level["n"][at],
                "n_children": level["children"][at],
                "n_leaves": level["leaves"][at],
                "saved": level["saved"][at],
                "chars": level["chars"][at],
                "ends": [None if s else _hash_of(conv[r : r + e]) if e else nothing for r, e, s in zip(row.tolist(), ends.tolist(), shared)],
            }
        for i in np.flatnonzero(level["shared"] & (level["ends"] > 0)):
            r, e = int(level["row"][i]), int(level["ends"][i])
            for lo in range(r, r + e, IDS_PER_CHUNK):
                ids = conv[lo : min(lo + IDS_PER_CHUNK, r + e)]
                yield {"kind": ["ends"], "conv_id": ids[:1], "key": [key_of[i]], "ids": [",".join(map(str, ids.tolist()))]}


def _shard_task(batches):
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    conv = np.concatenate([b.column(0).to_numpy() for b in held])
    turns = pa.concat_arrays([b.column(1) for b in held])
    for columns in shard_rows(conv, turns):
        n = len(columns["kind"])
        arrays = [pa.nulls(n, t) if name not in columns else pa.array(columns[name], t) if not isinstance(columns[name], pa.Array) else columns[name] for name, t in zip(_NAMES, _TYPES)]
        yield pa.RecordBatch.from_arrays(arrays, _NAMES)


# ---- all shards -----------------------------------------------------------


def _digests(chunks: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of a key's chunks of ids, joined in order of their first id, one chunk in memory at a time."""

    def run(batches):
        key, state = None, None
        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if key is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.digest()], pa.binary())], ["key", "ends"])
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.digest()], pa.binary())], ["key", "ends"])

    placed = chunks.repartition("key").sortWithinPartitions("key", "conv_id")
    return placed.select("key", "ids").mapInArrow(run, "key binary, ends binary")


def _subtree_sums(own: DataFrame, deepest: int) -> DataFrame:
    """(key, n_leaves, saved) summed over the nodes below and at each key, by doubling pointers to ancestors."""
    state = own.select("key", F.col("parent_key").alias("up"), "n_leaves", "saved")
    for _ in range(math.ceil(math.log2(deepest + 1))):
        sent = state.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        above = state.select(F.col("key").alias("up"), F.col("up").alias("next"))
        joined = state.join(sent, "key", "left").join(above, "up", "left")
        state = cut_lineage(
            joined.select(
                "key", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")
            )
        )
    return state.drop("up")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id unique, turns as made by ``turn_lists`` or ``grafted``).

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (NULL at the root),
    ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes at or below), ``saved_tokens`` (code
    points that repeat at or below) and ``ends_sha256`` (of the ids that end here).
    """
    spark = convs.sparkSession
    convs = cut_lineage(convs.select("conv_id", "turns"))
    total = convs.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, math.ceil(total / TURNS_PER_SHARD), min(usual, math.ceil(total / LEAST_TURNS)))
    ranged = convs.withColumn("order", F.transform("turns", lambda t: t["name"])).repartitionByRange(shards, "order", "conv_id")
    out = cut_lineage(ranged.select("conv_id", "turns").mapInArrow(_shard_task, _SCHEMA))

    parts = out.where("kind = 'part'").groupBy("key").agg(
        F.min("parent_key").alias("parent_key"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
    )
    parts = cut_lineage(parts)
    more = parts.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    known = parts.join(more, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    own = known.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("chars"))
    own = cut_lineage(own.select("key", "parent_key", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved"))
    size, deepest = own.agg(F.count("*"), F.max("depth")).first()
    sums = _subtree_sums(own, deepest or 0)
    named = own.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    ends = _digests(out.where("kind = 'ends'").select("key", "conv_id", "ids"))
    split = own.drop("n_leaves", "saved").join(sums, "key").join(ends, "key", "left").join(named, "parent_key", "left")

    whole = out.where("kind = 'node'")
    by_key = F.broadcast(named) if size <= BROADCAST_ROWS else named  # paths of shard ends; more than that are joined by shuffle
    tops = whole.where("parent_key IS NOT NULL").drop("parent_conv_id").join(by_key, "parent_key")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends"]
    found = whole.where("parent_key IS NULL").select(*columns).unionByName(tops.select(*columns)).unionByName(split.select(*columns))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return found.withColumn("ends_sha256", F.coalesce(F.lower(F.hex("ends")), none)).drop("ends")
