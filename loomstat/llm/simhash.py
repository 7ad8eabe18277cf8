"""SimHash near-duplicates by joining a binary trie of fingerprints with itself.

Two fingerprints that differ in at most ``budget`` bits agree in one of ``budget + 1``
slices.  So the fingerprint bits are turned until that slice leads, once per slice, and
the nodes below equal slices are the roots of the self-join.  From a pair of nodes the
join goes on to the pairs of their children; a pair of different children costs one bit,
and a pair whose bits exceed the budget is left.  Large node pairs are split over tasks
level by level (``_split``), small ones are finished within a task, so no task gets an
unbounded node.

``groups`` links 64-bit fingerprints at a few bits.  A fingerprint has at most a ball's
worth of partners (2,080 at two bits of 64), so the links grow with the distinct
fingerprints, however large a group of copies is: copies share one fingerprint.

NULL and empty texts have the fingerprint zero, which links like any other.  NULL ids never
become a component's id (a component of such rows only has a NULL id).  Repeated rows stay;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.blocks import give_back, rows_of
from loomstat.llm.bpe import gather
from loomstat.llm.graph import components
from loomstat.operators.joins import salted_join
from loomstat.session import cut_lineage

WORD, SEED, NODE_ROWS, STEP, PAIRS = 64, 42, 5000, 4, 200_000


# ---- fingerprints ---------------------------------------------------------


def shingles(text: bytes, words: int) -> list[bytes]:
    """Word shingles of a text: A-Z lower-cased, ASCII white space apart, one space between words."""
    parts = text.lower().split()
    if len(parts) <= words:
        return [b" ".join(parts)] if parts else []
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    return [line[a:b] for a, b in zip(begins.tolist(), ends[words - 1 :].tolist(), strict=False)]


def hashes(text: bytes, words: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(s, SEED) for s in shingles(text, words)], "<u8")


def majority(values: np.ndarray) -> np.ndarray:
    """One 64-bit word: the bits set in over half of ``values``."""
    total = np.zeros(WORD, np.int64)
    for at in range(0, len(values), 65536):
        total += np.unpackbits(values[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > len(values), bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) per row; fp is the 64-bit fingerprint as a signed number."""

    def run(batches):
        for batch in batches:
            fps = [majority(hashes((t or "").encode(), words)).view("<i8")[0] for _, t in rows_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])
        give_back()

    return _named(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))


# ---- the trie self-join ---------------------------------------------------


def _slices(bits: int, budget: int) -> list[tuple[int, int]]:
    """(first bit from the top, width) of the ``budget + 1`` slices."""
    edges = [round(i * bits / (budget + 1)) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _roots(values: DataFrame, table: Column, value: Column, low: Column, bits: int, budget: int, rest: list[str]) -> DataFrame:
    """One row per value and slice: x has the turned value in its leading bits, then ``low``."""
    made = None
    width = (1 << bits) - 1 if bits < WORD else -1
    for s, (at, lead) in enumerate(_slices(bits, budget)):
        turned = value if at == 0 else F.shiftleft(value, at).bitwiseOR(F.shiftrightunsigned(value.bitwiseAND(width), bits - at)).bitwiseAND(width)
        x = turned if bits == WORD else F.shiftleft(turned, WORD - bits).bitwiseOR(low)
        part = values.select((table * (budget + 1) + s).alias("turn"), F.lit(lead).alias("depth"), x.alias("x"), *rest)
        made = part if made is None else made.unionByName(part)
    first = F.call_function("shiftrightunsigned", F.col("x"), (F.lit(WORD) - F.col("depth")).cast("int"))
    return made.select("turn", "depth", first.alias("a"), first.alias("b"), "x", *rest)


def _split(rows: DataFrame, bits: int, budget: int, node_rows: int, rest: list[str]) -> DataFrame:
    """Take node pairs of more than ``node_rows`` rows apart, level by level, until none is left.

    Below the value's bits the levels cost nothing: there equal values are only dealt out.
    """
    pair = ["turn", "depth", "a", "b"]
    while True:
        large = cut_lineage(rows.groupBy(*pair).count().where((F.col("count") > node_rows) & (F.col("depth") < WORD)).drop("count"))
        if large.isEmpty():
            return rows
        deeper = rows.join(large, pair, "left_semi").withColumn("deep", F.least(F.col("depth") + STEP, F.lit(WORD)))
        deeper = deeper.withColumn("parent", F.call_function("shiftrightunsigned", F.col("x"), (F.lit(WORD) - F.col("depth")).cast("int")))
        deeper = deeper.withColumn("mine", F.call_function("shiftrightunsigned", F.col("x"), (F.lit(WORD) - F.col("deep")).cast("int")))
        down = (F.col("deep") - F.col("depth")).cast("int")
        first = F.call_function("shiftleft", F.when(F.col("parent") == F.col("a"), F.col("b")).otherwise(F.col("a")), down)
        partners = F.transform(F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), down) - 1), lambda i: first + i)
        below = F.greatest(F.col("deep") - bits, F.lit(0)).cast("int")
        near = F.filter(partners, lambda q: F.bit_count(F.call_function("shiftrightunsigned", q.bitwiseXOR(F.col("mine")), below)) <= budget)
        split = deeper.withColumn("partner", F.explode(near))
        low, high = F.least("mine", "partner").alias("a"), F.greatest("mine", "partner").alias("b")
        inside = split.select("turn", F.col("deep").alias("depth"), low, high, "x", *rest)
        rows = cut_lineage(rows.join(large, pair, "left_anti").unionByName(inside))


def _leaves(x: np.ndarray, bits: int, budget: int, begin: int, end: int, depth: int, a: int, b: int) -> list[tuple]:
    """Pairs of ranges of x that are small or cannot be told apart, below one pair of nodes."""
    found = []

    def visit(p, q, r, s, bit, used):
        if used > budget or p == q or r == s:
            return
        if (q - p) * (s - r) <= 4096:
            found.append((p, q, r, s))
            return
        if bit >= bits:  # values that cannot be told apart: some rows at a time against all
            step = max(1, PAIRS // (s - r))
            found.extend((x1, min(x1 + step, q), x1 if (p, q) == (r, s) else r, s) for x1 in range(p, q, step))
            return
        one = 1 << (WORD - 1 - bit)

        def cut(lo, hi):  # where the bit is set from on; all above it is equal within lo:hi
            return lo + int(np.searchsorted(x[lo:hi], np.uint64(int(x[lo]) // (2 * one) * 2 * one + one)))

        m = cut(p, q)
        if (p, q) == (r, s):
            steps = ((p, m, p, m, used), (m, q, m, q, used), (p, m, m, q, used + 1))
        else:
            n = cut(r, s)
            steps = ((p, m, r, n, used), (m, q, n, s, used), (p, m, n, s, used + 1), (m, q, r, n, used + 1))
        for *ranges, cost in steps:
            visit(*ranges, bit + 1, cost)

    if a == b:
        visit(begin, end, begin, end, depth, 0)
    else:
        m = begin + int(np.searchsorted(x[begin:end] >> np.uint64(WORD - depth), np.uint64(b)))
        visit(begin, m, m, end, depth, ((a ^ b) >> max(depth - bits, 0)).bit_count())
    return found


def _near_pairs(turn, depth, a, b, x, bits: int, budget: int):
    """(u, v) indices of rows within the budget, some hundred thousand candidates at a time."""
    fresh = np.ones(len(x), bool)
    fresh[1:] = (turn[1:] != turn[:-1]) | (depth[1:] != depth[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    begin = np.flatnonzero(fresh)
    end = np.append(begin[1:], len(x))
    several = end - begin > 1

    def leaves():
        for i, j in zip(begin[several].tolist(), end[several].tolist(), strict=True):
            yield from _leaves(x, bits, budget, i, j, int(depth[i]), int(a[i]), int(b[i]))
        yield None

    held, size = [], 0
    for leaf in leaves():
        if held and (leaf is None or size > PAIRS):
            lo, hi, lo2, hi2 = (np.array(v, np.int64) for v in zip(*held, strict=True))
            each = np.repeat(hi2 - lo2, hi - lo)
            u, v = np.repeat(gather(lo, hi - lo), each), gather(np.repeat(lo2, hi - lo), each)
            ok = ~np.repeat(np.repeat(lo == lo2, hi - lo), each) | (u < v)
            u, v = u[ok], v[ok]
            ok = np.bitwise_count((x[u] ^ x[v]) >> np.uint64(WORD - bits)) <= budget
            yield u[ok], v[ok]
            held, size = [], 0
        if leaf is not None:
            held.append(leaf)
            size += (leaf[1] - leaf[0]) * (leaf[3] - leaf[2])


def _join_nodes(links: Callable):
    """Sorted rows (turn, depth, a, b, x, ...) -> batches of ``links(columns)``, whole node pairs at a time."""

    def run(batches):
        held, rest = None, None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            more = pa.Table.from_batches([batch.select(batch.schema.names[5:])]) if batch.num_columns > 5 else None
            held = now if held is None else [np.concatenate(p) for p in zip(held, now, strict=True)]
            rest = more if rest is None else pa.concat_tables([rest, more])
            last = np.flatnonzero(np.logical_or.reduce([h[1:] != h[:-1] for h in held[:4]]))
            if len(last):
                cut = int(last[-1]) + 1
                yield from links(*_unsigned([h[:cut] for h in held]), None if rest is None else rest.slice(0, cut))
                held, rest = [h[cut:] for h in held], None if rest is None else rest.slice(cut)
        if held is not None:
            yield from links(*_unsigned(held), rest)
        give_back()

    return run


def _unsigned(columns: list[np.ndarray]) -> list[np.ndarray]:
    turn, depth, *wide = columns
    return [turn, depth, *(np.ascontiguousarray(w).view(np.uint64) for w in wide)]


def _nodes(rows: DataFrame) -> DataFrame:
    keys = ["turn", "depth", "a", "b"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "x")


# ---- links of single fingerprints -----------------------------------------


def links(fps: DataFrame, budget: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """(u, v): every pair of distinct fingerprints of ``fps`` (fp) that differ in at most ``budget`` bits, once."""
    slices = _slices(WORD, budget)
    first_bits = np.array([at for at, _ in slices], np.int64)

    def found(turn, depth, a, b, x, rest):
        for u, v in _near_pairs(turn, depth, a, b, x, WORD, budget):
            far, back = x[u] ^ x[v], first_bits[turn[u]]
            once = np.ones(len(u), bool)  # a pair counts in the first slice in which it agrees
            for s, (at, width) in enumerate(slices):
                shift = (WORD - (at - back) % WORD - width).astype(np.uint64)
                once &= (turn[u] <= s) | ((far >> shift) & np.uint64((1 << width) - 1) != 0)
            ends = [pa.array(_turned_back(x[i[once]], back[once].astype(np.uint64)).view(np.int64)) for i in (u, v)]
            yield pa.RecordBatch.from_arrays(ends, ["u", "v"])

    distinct = fps.select("fp").distinct()
    rows = cut_lineage(_roots(distinct, F.lit(0), F.col("fp"), F.lit(0), WORD, budget, []))
    return _nodes(_split(rows, WORD, budget, node_rows, [])).mapInArrow(_join_nodes(found), "u long, v long")


def _turned_back(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    wide = np.uint64(WORD)
    return np.where(bits == 0, x, (x >> bits) | (x << (wide - bits) % wide))


def groups(fps: DataFrame, budget: int = 2) -> DataFrame:
    """``fps`` (doc_id, fp) with ``component_id``, the smallest doc_id that links lead to."""
    found = components(links(fps, budget))
    sizes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    rooted = sizes.join(found, sizes["fp"] == found["node"], "left").select("fp", "rep", "n", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return salted_join(fps, cut_lineage(rooted.join(least, "root").select("fp", "n", "component_id")), "fp", "doc_id", "n").drop("n")
