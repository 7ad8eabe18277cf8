"""Repeated byte windows by a depth-limited radix sort, most significant digit first.

Wanted: every byte covered by a ``threshold``-byte window that also begins in a document
with a smaller id.  Ordering the suffixes of all bytes needs a shuffled entry per byte,
many times the input.  So the digits are chosen by content, not by place:

* digit 1 of a window is the smallest hash among its ``k``-byte substrings.  Neighbouring
  windows share it, so a *run* of windows with one first digit is one entry.  Equal
  windows have equal first digits, wherever they stand.
* digit 2 is the content of the whole run.  Runs equal in both digits hold the same
  windows: all but those of the smallest document are repeats.
* digit 3, the full depth: the single windows.  Only runs that share digit 1 with a
  different run, and are the first of their content, still need it.

Each pass deals entries to buckets by the digit, sorts a bucket, drops groups of one, and
tells the blocks of documents what is left.  A block sends a digit once (from pass 2 on
with its smallest id), so a passage found in a third of all documents is one entry per
block, and no pair is ever made.  The texts are shuffled once, packed; every pass reads
that one exchange.  Digit 1 has 32 bits in its bucket (a clash costs work, not
correctness), digit 2 has 64 bits next to those, windows have 96.

NULL texts are empty; texts shorter than the threshold lose nothing.  Rows with equal
ids are not compared with each other, and NULL ids come after all others.  Repeated rows
give repeated results; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.llm.blocks import buckets_for, cells, dealt, key_of, pack, smallest, text_packs, unpack
from loomstat.llm.bpe import gather
from loomstat.llm.windows import hashes_at, mixed, odd, sliding, window_hashes, words_at_every_byte

BLOCK_BYTES, CHUNK_BYTES = 8_000_000, 1_000_000
_LAST = np.iinfo(np.int64).max  # the id of rows without one
_ROW = "kind string, key long, block long, cell binary"
OUT = "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"


# ---- a block of documents -----------------------------------------------------


class Block:
    """The documents of one block, one after another in one buffer, and their runs.

    ``runs()`` finds runs of neighbouring windows with one first digit: ``start``,
    ``n`` windows, ``digit``, ``content`` and ``doc`` (the number of the document).
    """

    def __init__(self, ids: list, texts: list[bytes], threshold: int):
        self.ids = np.array([_LAST if i is None else i for i in ids], np.int64)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.threshold = threshold

    def runs(self) -> tuple[np.ndarray, ...]:
        t, k = self.threshold, _digit_bytes(self.threshold)
        whole = np.zeros(len(self.bytes), bool)  # does a window that stays in its document begin here?
        for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            whole[a : max(a, b - t + 1)] = True
        power, back = _powers(CHUNK_BYTES + t)
        found = []
        for at in range(0, len(self.bytes), CHUNK_BYTES):
            part = self.bytes[at : at + CHUNK_BYTES + t - 1]
            grams = window_hashes(words_at_every_byte(part), k)
            least = sliding(np.minimum, grams, t - k + 1)
            ok = whole[at : at + len(least)]
            if not ok.any():
                continue
            begins = ok.copy()
            begins[1:] &= ~ok[:-1] | (least[1:] != least[:-1])
            closes = ok.copy()
            closes[:-1] &= ~ok[1:] | (least[1:] != least[:-1])
            first, last = np.flatnonzero(begins), np.flatnonzero(closes)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(grams * power[: len(grams)], dtype=np.uint64)])
            content = (sums[last + t - k + 1] - sums[first]) * back[first]
            n = last - first + 1
            found.append((first + at, n, least[first], mixed(content + n.astype(np.uint64) * odd(5))))
        if found:
            start, n, digit, content = (np.concatenate(x) for x in zip(*found, strict=True))
        else:
            start = n = np.zeros(0, np.int64)
            digit = content = np.zeros(0, np.uint64)
        return start, n, mixed(digit), content, np.searchsorted(self.starts, start, side="right") - 1


def _digit_bytes(threshold: int) -> int:
    return max(8, threshold * 5 // 8)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if n not in _POWERS:
        base = int(odd(11))
        _POWERS[n] = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, b, np.uint64))]) for b in (base, pow(base, -1, 1 << 64)))
    return _POWERS[n]


def _blocks(packs: pa.Table, threshold: int):
    """(key, ids, block) of every different block among these rows; equal blocks say the same."""
    for key, cell in dict(zip(packs.column("key").to_pylist(), packs.column("cell").to_pylist(), strict=True)).items():
        ids, texts = _documents(cell)
        yield key, Block(ids, texts, threshold)


def _documents(cell: bytes) -> tuple[list, list[bytes]]:
    ids, sizes, blob = unpack(cell)
    return ids, [blob[a:b] for a, b in itertools.pairwise([0, *np.cumsum(sizes).tolist()])]


def _first_digits(block: Block, digit: np.ndarray, doc: np.ndarray, buckets: int):
    """Distinct first digits by bucket: (32-bit codes, bucket edges, entry of each run, in several documents of the block)."""
    place = ((digit >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | digit & np.uint64(0xFFFFFFFF)
    entries, of_run = np.unique(place, return_inverse=True)
    low, high = np.full(len(entries), _LAST), np.full(len(entries), -_LAST)
    np.minimum.at(low, of_run, block.ids[doc])
    np.maximum.at(high, of_run, block.ids[doc])
    edges = np.searchsorted(entries >> np.uint64(32), np.arange(buckets + 1).astype(np.uint64))
    return entries.astype(np.uint32), edges, of_run, low < high


def _contents(block: Block, digit: np.ndarray, content: np.ndarray, doc: np.ndarray, buckets: int):
    """Distinct runs by bucket with their smallest id: (codes, contents, ids), bucket edges, entry of each run."""
    order, group, fresh = _grouped(block.ids[doc], content)
    head = order[fresh]
    by_id = np.argsort(block.ids[doc[head]], kind="stable")
    inner, edges = dealt(((digit[head] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)[by_id], buckets)
    place = by_id[inner]
    rank = np.empty(len(place), np.int64)
    rank[place] = np.arange(len(place))
    of_run = np.empty(len(order), np.int64)
    of_run[order] = rank[group]
    head = head[place]
    return (digit[head].astype(np.uint32), content[head], block.ids[doc[head]]), edges, of_run


def _grouped(owner: np.ndarray, *keys: np.ndarray):
    """(order, group, first of its group) of entries sorted by ``keys``, then ``owner``."""
    order = np.lexsort((owner, *keys))
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.cumsum(fresh) - 1, fresh


def _steps(sorted_values: np.ndarray) -> np.ndarray:
    """Sorted numbers as steps, which take fewer bytes."""
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


def _rows(out: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([cells("kind key block cell", out)])


def _of_kind(rows: pa.Table, kind: str) -> tuple[list, list, list]:
    """(keys, blocks, cells) of the rows of one kind."""
    columns = (rows.column(c).to_pylist() for c in ("kind", "key", "block", "cell"))
    mine = [r[1:] for r in zip(*columns, strict=True) if r[0] == kind]
    return tuple(map(list, zip(*mine, strict=True))) if mine else ([], [], [])


def _answers(keys: list, blocks: list, sizes: list[int], told: np.ndarray, *values: np.ndarray) -> pa.Table:
    """One row per block: which of its entries are told, and their values."""
    out, end = [], 0
    for bucket, block, n in zip(keys, blocks, sizes, strict=True):
        mine = np.flatnonzero(told[end : end + n])
        if len(mine):
            out.append(("own", block, bucket, pack(smallest(_steps(mine)), *(v[end : end + n][mine] for v in values))))
        end += n
    return _rows(out)


def _told(rows: pa.Table) -> list[tuple]:
    """(bucket, entries, values...) of the answers of a block."""
    found = []
    for bucket, cell in zip(rows.column("block").to_pylist(), rows.column("cell").to_pylist(), strict=True):
        steps, *values = unpack(cell)
        found.append((bucket, np.cumsum(steps, dtype=np.int64), *values))
    return found


# ---- pass 1: first digits --------------------------------------------------------


def _send_digits(threshold: int, buckets: int):
    def run(packs: pa.Table) -> pa.Table:
        out = []
        for key, block in _blocks(packs, threshold):
            _, _, digit, _, doc = block.runs()
            codes, edges, _, _ = _first_digits(block, digit, doc, buckets)
            for b in np.flatnonzero(np.diff(edges)).tolist():
                out.append(("digits", b, key, pack(_steps(codes[edges[b] : edges[b + 1]]))))
        return _rows(out)

    return run


def _sort_digits(rows: pa.Table) -> pa.Table:
    """Of one bucket: the digits that several blocks hold."""
    keys, blocks, packed = _of_kind(rows, "digits")
    codes = [np.cumsum(unpack(c)[0], dtype=np.uint32) for c in packed]
    _, at, counts = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
    return _answers(keys, blocks, [len(c) for c in codes], counts[at] > 1)


# ---- pass 2: whole runs -----------------------------------------------------------


def _alive(block: Block, digit: np.ndarray, doc: np.ndarray, buckets: int, told: list[tuple]) -> np.ndarray:
    """Which runs share their first digit with another document."""
    _, edges, of_run, shared = _first_digits(block, digit, doc, buckets)
    for bucket, entries in told:
        shared[edges[bucket] + entries] = True
    return np.flatnonzero(shared[of_run])


def _send_runs(threshold: int, buckets: int):
    def run(packs: pa.Table, replies: pa.Table) -> pa.Table:
        out, told = [], _told(replies)
        for key, block in _blocks(packs, threshold):
            _, _, digit, content, doc = block.runs()
            alive = _alive(block, digit, doc, buckets, told)
            (codes, contents, owners), edges, _ = _contents(block, digit[alive], content[alive], doc[alive], buckets)
            for b in np.flatnonzero(np.diff(edges)).tolist():
                mine = slice(edges[b], edges[b + 1])
                out.append(("runs", b, key, pack(codes[mine], contents[mine], _steps(owners[mine]))))
            out.append(("own", key, 0, pack(smallest(_steps(alive)))))
        return _rows(out)

    return run


def _sort_runs(rows: pa.Table) -> pa.Table:
    """Of one bucket: the smallest id of the runs that are found again, or share digit 1 with a different run."""
    keys, blocks, packed = _of_kind(rows, "runs")
    if not keys:
        return _rows([])
    parts = [unpack(c) for c in packed]
    code, content = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    owner = np.concatenate([np.cumsum(p[2]) for p in parts])
    order, group, fresh = _grouped(owner, content, code)
    least, kinds = owner[order][fresh], code[order][fresh]
    several = np.zeros(len(kinds), bool)
    several[1:] |= kinds[1:] == kinds[:-1]
    several[:-1] |= kinds[1:] == kinds[:-1]
    told, answer = np.zeros(len(owner), bool), np.empty(len(owner), np.int64)
    told[order] = (owner[order] > least[group]) | several[group]
    answer[order] = least[group]
    return _answers(keys, blocks, [len(p[0]) for p in parts], told, answer)


def _gathered(rows: pa.Table, replies: pa.Table) -> pa.Table:
    """What a block kept for itself, with the answers to what it sent, in one cell."""
    keys, _, kept = _of_kind(rows, "own")
    if not keys:
        return _rows([])
    told = list(zip(replies.column("block").to_pylist(), replies.column("cell").to_pylist(), strict=True))
    return _rows([("own", keys[0], 0, pack(kept[0], told))])


# ---- pass 3: windows ----------------------------------------------------------------


def _send_windows(threshold: int, buckets: int):
    """The bytes of a block that are decided, and the windows that are not."""

    def run(packs: pa.Table, states: pa.Table) -> pa.Table:
        out = []
        for key, block in _blocks(packs, threshold):
            own, told = unpack(states.column("cell")[0].as_py())
            start, n, digit, content, doc = block.runs()
            alive = np.cumsum(unpack(own)[0], dtype=np.int64)
            start, n, digit, content, doc = (x[alive] for x in (start, n, digit, content, doc))
            (_, _, owner), edges, of_run = _contents(block, digit, content, doc, buckets)
            least, answered = owner.copy(), np.zeros(len(owner), bool)
            for bucket, cell in told:
                steps, smallest_id = unpack(cell)
                at = edges[bucket] + np.cumsum(steps, dtype=np.int64)
                least[at], answered[at] = smallest_id, True
            repeats = block.ids[doc] > least[of_run]
            cover = np.zeros(len(block.bytes) + 1, np.int32)
            _covered(cover, start[repeats], n[repeats] + threshold - 1)
            unsure = answered[of_run] & ~repeats
            places, docs = gather(start[unsure], n[unsure]), np.repeat(doc[unsure], n[unsure])
            one, two = hashes_at(block.bytes, places, threshold, (1, 2))
            two = two.astype(np.uint32)
            order, group, fresh = _grouped(block.ids[docs], two, one)
            first_id = block.ids[docs][order][fresh]
            again = np.zeros(len(places), bool)
            again[order] = block.ids[docs][order] > first_id[group]
            _covered(cover, places[again], threshold)
            # what is left: windows first in this block, by bucket; a window may stand at several places
            head = order[fresh]
            by_id = np.argsort(first_id, kind="stable")
            inner, bounds = dealt((one[head] % np.uint64(buckets)).astype(np.int64)[by_id], buckets)
            place_of = by_id[inner]
            number = np.empty(len(head), np.int64)
            number[place_of] = np.arange(len(head))
            slot = np.empty(len(places), np.int64)
            slot[order] = number[group]
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                mine = head[place_of[bounds[b] : bounds[b + 1]]]
                out.append(("windows", b, key, pack(one[mine], two[mine], _steps(block.ids[docs[mine]]))))
            gone = np.packbits(np.cumsum(cover[:-1], dtype=np.int32) > 0)
            out.append(("own", key, 0, pack(gone, smallest(_steps(places[~again])), smallest(slot[~again]), bounds)))
        return _rows(out)

    return run


def _covered(cover: np.ndarray, at: np.ndarray, size) -> None:
    """Count the ranges ``at .. at + size`` in an array of steps."""
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)


def _sort_windows(rows: pa.Table) -> pa.Table:
    """Of one bucket: the windows that also begin in a smaller document."""
    keys, blocks, packed = _of_kind(rows, "windows")
    if not keys:
        return _rows([])
    parts = [unpack(c) for c in packed]
    one, two = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    owner = np.concatenate([np.cumsum(p[2]) for p in parts])
    order, group, fresh = _grouped(owner, two, one)
    again = np.zeros(len(owner), bool)
    again[order] = owner[order] > owner[order][fresh][group]
    return _answers(keys, blocks, [len(p[0]) for p in parts], again)


# ---- the result -----------------------------------------------------------------------


def _finish(threshold: int):
    def run(packs: pa.Table, states: pa.Table) -> pa.Table:
        out = []
        for cell in packs.column("cell").to_pylist():
            ids, texts = _documents(cell)
            own, told = unpack(states.column("cell")[0].as_py())
            gone, places, slot, bounds = unpack(own)
            total = sum(map(len, texts))
            again = np.zeros(int(bounds[-1]), bool)
            for bucket, answer in told:
                again[bounds[bucket] + np.cumsum(unpack(answer)[0], dtype=np.int64)] = True
            cover = np.zeros(total + 1, np.int32)
            _covered(cover, np.cumsum(places, dtype=np.int64)[again[slot.astype(np.int64)]], threshold)
            out.append(_finished(ids, texts, np.unpackbits(gone, count=total).astype(bool) | (np.cumsum(cover[:-1], dtype=np.int32) > 0)))
        return pa.Table.from_batches(out)

    return run


def _finished(ids: list, texts: list[bytes], gone: np.ndarray) -> pa.RecordBatch:
    """The result rows of documents whose removed bytes are known."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begin = ends - sizes
    raw = np.frombuffer(b"".join(texts), np.uint8)
    edge = np.zeros(len(raw) + 1, bool)
    edge[begin] = True  # documents end spans
    before = np.concatenate([[False], gone[:-1]]) if len(gone) else gone
    after = np.concatenate([gone[1:], [False]]) if len(gone) else gone
    first = np.flatnonzero(gone & (~before | edge[:-1]))
    last = np.flatnonzero(gone & (~after | edge[1:])) + 1
    owner = np.searchsorted(ends, first, side="right")
    lists = np.searchsorted(owner, np.arange(len(ids) + 1))
    kept_ends = np.concatenate([[0], np.cumsum(~gone)])
    kept = raw[~gone].tobytes()
    spans = pa.StructArray.from_arrays([pa.array((first - begin[owner]).astype(np.int32)), pa.array((last - begin[owner]).astype(np.int32))], ["start", "end"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(sizes),
            pa.ListArray.from_arrays(pa.array(lists, pa.int32()), spans),
            pa.array([kept[a:b] for a, b in zip(kept_ends[begin].tolist(), kept_ends[ends].tolist(), strict=True)], pa.binary()),
        ],
        ["doc_id", "n_bytes", "spans", "kept"],
    )


def remove_repeats(docs: DataFrame, threshold: int = 50, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, the removed ``spans`` (bytes, end exclusive) and the ``kept`` bytes."""
    if threshold < 16:
        raise ValueError("the threshold must be 16 bytes or more")
    buckets = buckets_for(docs)

    def packed(batches):
        for ids, texts in text_packs(batches, block_bytes):
            cell = pack(ids, np.array([len(t) for t in texts], np.int64), b"".join(texts))
            yield cells("key cell", [(key_of(cell), cell)])

    def beside_packs(rows: DataFrame, fn, schema: str) -> DataFrame:
        return packs.groupBy("key").cogroup(rows.groupBy("key")).applyInArrow(fn, schema)

    def asked(sent: DataFrame, sort) -> DataFrame:
        """Blocks get what the buckets answer to what they sent; both sides read one exchange."""
        routed = sent.repartition("kind", "key")
        replies = routed.groupBy("kind", "key").applyInArrow(sort, _ROW)
        return routed.groupBy("kind", "key").cogroup(replies.groupBy("kind", "key")).applyInArrow(_gathered, _ROW)

    named = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].cast("string").alias("text"))
    packs = named.mapInArrow(packed, "key long, cell binary").repartition("key")
    digits = packs.groupBy("key").applyInArrow(_send_digits(threshold, buckets), _ROW).groupBy("key").applyInArrow(_sort_digits, _ROW)
    runs = asked(beside_packs(digits, _send_runs(threshold, buckets), _ROW), _sort_runs)
    windows = asked(beside_packs(runs, _send_windows(threshold, buckets), _ROW), _sort_windows)
    return beside_packs(windows, _finish(threshold), OUT)


def with_counts(found: DataFrame) -> DataFrame:
    """The result with ``n_removed`` and ``n_spans``."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_removed", removed).withColumn("n_spans", F.size("spans").cast("bigint"))
