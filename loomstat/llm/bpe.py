"""Byte-level BPE: every distinct pre-token of the corpus is merged once.

Encoding, in three steps over packed rows (see ``blocks``):

1. Documents are cut into pre-tokens.  A block of documents keeps, per position, the
   number of the pre-token in the block's own list, and sends its distinct pre-tokens
   to the bucket of their hash.
2. A bucket sees each distinct pre-token of the corpus (at most once per block) and
   merges it once.
3. The ids go back to the blocks, which put them together by position.

Steps 1 and 3 share one shuffle.  A pre-token that fills a third of the corpus is one
entry per block.  Decoding joins the table of token bytes: the ids index into it.

NULL and empty texts give no ids; NULL ids, repeated ids and repeated rows are kept row
by row; an empty table gives an empty result; other columns are not read.  A very long
pre-token takes n log n steps.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loomstat.llm.blocks import buckets_for, cells, dealt, give_back, key_of, pack, rows_of, smallest, unpack

BLOCK_CHARS, DECODE_TOKENS = 4_000_000, 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    """token -> rank of a rank file: a token in base64 and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank is joined, the leftmost first, until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # part i is piece[i:end[i]]
    heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if j is None or j >= n or end[j] != stop:
            continue  # one of the two parts has changed since
        end[i], end[j] = stop, None
        if stop < n:
            before[stop] = i
            longer = piece[i : end[stop]]
            if longer in ranks:
                heapq.heappush(heap, (ranks[longer], i, end[stop]))
        if before[i] >= 0:
            longer = piece[before[i] : stop]
            if longer in ranks:
                heapq.heappush(heap, (ranks[longer], before[i], stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


def _cut(pattern: str, buckets: int, block_chars: int):
    """Documents -> one 'place' row per block, one 'words' row per block and bucket."""

    def block(ids, sizes, index, seq):
        words = [w.encode() for w in index]
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        order, edges = dealt(bucket, buckets)
        number = np.empty(len(words), np.uint32)
        number[order] = np.arange(len(words), dtype=np.uint32)
        place = pack(ids, np.array(sizes, np.int64), smallest(number[np.array(seq, np.uint32)]), len(words))
        key, rows = key_of(place), []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            mine = [words[i] for i in order[edges[b] : edges[b + 1]]]
            rows.append(("words", b, key, pack(smallest(np.array([len(w) for w in mine])), b"".join(mine))))
        return cells("kind key block cell", [*rows, ("place", key, key, place)])

    def run(batches):
        import regex

        find = regex.compile(pattern).findall
        index, seq, ids, sizes, held = defaultdict(itertools.count().__next__), array("I"), [], [], 0
        for batch in batches:
            for i, text in rows_of(batch):
                words = find(text or "")
                seq.extend(map(index.__getitem__, words))
                ids.append(i)
                sizes.append(len(words))
                held += len(text or "") + 1
                if held >= block_chars:
                    yield block(ids, sizes, index, seq)
                    index, seq, ids, sizes, held = defaultdict(itertools.count().__next__), array("I"), [], [], 0
        if ids:
            yield block(ids, sizes, index, seq)
        give_back()

    return run


def _merge_bucket(ranks: dict[bytes, int]):
    """All lists of one bucket -> their ids, list by list."""

    def run(rows: pa.Table) -> pa.Table:
        known: dict[bytes, list[int]] = {}
        out = []
        for kind, bucket, block, cell in zip(*(rows.column(c).to_pylist() for c in ("kind", "key", "block", "cell")), strict=True):
            if kind != "words":
                continue
            sizes, blob = unpack(cell)
            ends = np.cumsum(sizes.astype(np.int64)).tolist()
            ids = []
            for a, b in itertools.pairwise([0, *ends]):
                word = blob[a:b]
                if word not in known:
                    known[word] = merge(word, ranks)
                ids.append(known[word])
            flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64)
            out.append(("place", block, bucket, pack(smallest(np.array([len(x) for x in ids])), smallest(flat))))
        return pa.Table.from_batches([cells("kind key block cell", out)])

    return run


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the runs ``starts[i] .. starts[i] + sizes[i]``, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _assemble(schema: pa.Schema):
    """A block and the ids of its pre-tokens -> the ids of its documents."""

    def run(places: pa.Table, replies: pa.Table) -> pa.Table:
        by_bucket = dict(zip(replies.column("block").to_pylist(), replies.column("cell").to_pylist(), strict=True))
        parts = [unpack(by_bucket[b]) for b in sorted(by_bucket)]
        counts = np.concatenate([np.zeros(0, np.int64), *(p[0].astype(np.int64) for p in parts)])
        flat = np.concatenate([np.zeros(0, np.int32), *(p[1].astype(np.int32) for p in parts)])
        starts = np.cumsum(counts) - counts
        out = []
        for kind, cell in zip(places.column("kind").to_pylist(), places.column("cell").to_pylist(), strict=True):
            if kind != "place":
                continue
            ids, sizes, seq, n_words = unpack(cell)
            if n_words != len(counts):
                raise ValueError(f"a block has {n_words} pre-tokens, {len(counts)} came back")
            seq = seq.astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(counts[seq])])
            edges = ends[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int32)
            tokens = pa.array(flat[gather(starts[seq], counts[seq])], pa.int32())
            out.append(pa.table([pa.array(ids, schema.field(0).type), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), tokens)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return run


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Per row: the id column and ``ids`` array<int>."""
    id_type = docs.schema[id_col].dataType
    named = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    spec = "kind string, key long, block long, cell binary"
    routed = named.mapInArrow(_cut(pattern, buckets_for(docs), block_chars), spec).repartition("kind", "key")
    replies = routed.groupBy("kind", "key").applyInArrow(_merge_bucket(ranks), spec)
    out = T.StructType([T.StructField(id_col, id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    arrow = pa.schema([pa.field(id_col, _arrow_type(id_type)), pa.field("ids", pa.list_(pa.int32()))])
    return routed.groupBy("kind", "key").cogroup(replies.groupBy("kind", "key")).applyInArrow(_assemble(arrow), out)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes its ids stand for; the table of token bytes has one row per rank."""
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    sizes = np.array([len(t) for t in table], np.int64)
    starts, blob = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(table), np.uint8)

    def run(batches):
        for batch in batches:
            lists = batch.column(ids_col)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)])
            made, row = [], 0
            while row < len(lists):  # some rows at a time, by their number of tokens
                last = max(row + 1, int(np.searchsorted(ends, ends[row] + DECODE_TOKENS, side="right")) - 1)
                mine = ids[ends[row] : ends[last]]
                parts = [mine[at : at + DECODE_TOKENS] for at in range(0, len(mine), DECODE_TOKENS)]
                raw = b"".join(blob[gather(starts[p], sizes[p])].tobytes() for p in parts)
                at = np.concatenate([[0], np.cumsum(sizes[mine])])[ends[row : last + 1] - ends[row]]
                made += [raw[a:b] for a, b in itertools.pairwise(at.tolist())]
                row = last
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*batch.schema.names, out_col])
        give_back()

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out_col, T.BinaryType())]))
