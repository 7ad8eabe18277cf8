"""Benchmark decontamination on canonical templates.

Words lose their punctuation and case; then numbers (any word with a digit), names (a
capital inside a sentence) and units become typed placeholders, whose values are the
*slots*.  Windows of ``window`` template tokens are joined by their hash with those of the
benchmark, each in up to three readings: with enough literal words as it stands; also, if a
capital opens a sentence in it, with that word as a name; and, if it has slots, with no
slot at all, so that verbatim copies match however many names and numbers they hold.
Matches of one document and item on one diagonal are put together: re-parameterised
questions must fill equal slots of the item with equal values.  Where a value of the item
meets two values, only windows without slots count.

Items shorter than the window (but of ``MIN_WORDS`` words) match as a whole.  Before the
join the windows of documents pass a bitmap of the benchmark's hashes; it has a fixed
size, lets no match get lost, and is only less selective for a larger benchmark.

NULL and empty texts match nothing; rows with NULL ids are judged together and give a
NULL id; repeated rows and ties give one result row per document id and item; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.llm import tokens
from loomstat.llm.blocks import give_back, rows_of
from loomstat.llm.bpe import gather
from loomstat.llm.windows import mixed, odd

WINDOW, MIN_LITERALS, MIN_WORDS = 10, 7, 5
BITMAP_BITS = 24
#: Words that count as units.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons tonne tonnes ml l liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros yen percent degree degrees celsius fahrenheit watt watts volt volts"
).split()
_NUMBER, _NAME, _UNIT = (odd(k) for k in (41, 43, 47))
CHUNK = 500_000
_SCHEMA = "id long, pos int, n int, hash long, slots array<long>"


def _unit_hashes() -> np.ndarray:
    buf, starts = tokens.joined([u.encode() for u in UNITS])
    return np.sort(tokens.plain_words(buf)[2])


def template(texts: list[bytes]):
    """(text number, template token, is a slot, word hash, opens with a capital) of every word that keeps a letter or digit."""
    buf, starts = tokens.joined(texts)
    begin, end, value, size, kept, rank = tokens.plain_words(buf)
    real = size > 0
    begin, end, value, rank = begin[real], end[real], value[real], rank[real]
    text = np.searchsorted(starts, begin, side="right") - 1
    number = tokens.has_digit(buf, begin, end)
    first = buf[kept[rank]]
    follow = buf[np.minimum(kept[rank] + 1, len(buf) - 1)] if len(buf) else first
    capital = ((first >= 65) & (first <= 90) & ((follow >= 97) & (follow <= 122) | (follow >= 128))) | (
        (first == 0xC3) & (follow >= 0x80) & (follow <= 0x9E) & (follow != 0x97)
    )
    opens = np.ones(len(begin), bool)  # does the word begin a sentence or a line?
    if len(begin) > 1:
        lines = np.concatenate([[0], np.cumsum(buf == 10)])
        stop = np.isin(buf[end[:-1] - 1], np.frombuffer(b".!?:;", np.uint8))
        opens[1:] = stop | (lines[begin[1:]] > lines[end[:-1]]) | (text[1:] != text[:-1])
    unit = np.isin(value, _unit_hashes())
    name = capital & ~opens & ~number & ~unit
    token = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, value)))
    return text, token, number | unit | name, value, capital & opens & ~number & ~unit


def windows(texts: list[bytes], lengths: list[tuple[int, int]]):
    """((text, first word, length, hash, first slot, last slot), slot values) of the windows of each (length, literals), in all readings."""
    text, token, slot, value, opener = template(texts)
    power, back = tokens.powers(len(token) + 1)
    words = np.bincount(text, minlength=len(texts)) if len(text) else np.zeros(len(texts), np.int64)
    first_of = np.cumsum(words) - words

    def before(marks):
        return np.concatenate([[0], np.cumsum(marks)])

    n_slots, n_openers = before(slot), before(opener)
    either = slot | opener
    readings = ((token, slot), (np.where(opener, _NAME, token), either), (value, np.zeros(len(value), bool)))
    found, values, held = [], [], 0
    for k, (read, gaps) in enumerate(readings):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(read) * power[: len(read)], dtype=np.uint64)])
        slots = before(gaps)
        for n, literals in lengths:
            if len(token) < n:
                continue
            one = text[n - 1 :] == text[: len(text) - n + 1]
            if k < 2:
                one &= n - (slots[n:] - slots[:-n]) >= literals
            if k:  # a reading of its own only where it differs from the first
                one &= (n_openers if k == 1 else n_slots)[n:] > (n_openers if k == 1 else n_slots)[:-n]
            if k == 1:  # the next sentence's first word alone adds nothing
                one &= ~opener[n - 1 :]
            at = np.flatnonzero(one)
            hashed = mixed((sums[at + n] - sums[at]) * back[at] + odd(53 + 2 * n))
            found.append((text[at], at - first_of[text[at]], np.full(len(at), n, np.int64), hashed, held + slots[at], held + slots[at + n]))
        values.append(value[gaps])
        held += len(values[-1])
    if not found:
        none = np.zeros(0, np.int64)
        return (none, none, none, none.astype(np.uint64), none, none), value[slot]
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)), np.concatenate(values)


def _batch(ids: pa.Array, found, values) -> pa.RecordBatch:
    text, pos, n, hashed, a, b = found
    ends = np.concatenate([[0], np.cumsum(b - a)]).astype(np.int32)
    slots = pa.ListArray.from_arrays(pa.array(ends), pa.array(values[gather(a, b - a)].view(np.int64)))
    columns = [ids.take(pa.array(text)), pa.array(pos.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(hashed.view(np.int64)), slots]
    return pa.RecordBatch.from_arrays(columns, ["id", "pos", "n", "hash", "slots"])


def _chunks(batches):
    """(ids, texts as bytes) of some megabytes."""
    for batch in batches:
        at, size, texts = 0, 0, []
        for i, (_, t) in enumerate(rows_of(batch)):
            texts.append((t or "").encode())
            size += len(texts[-1])
            if size >= CHUNK:
                yield batch.column(0).slice(at, len(texts)), texts
                at, size, texts = i + 1, 0, []
        if texts:
            yield batch.column(0).slice(at, len(texts)), texts
    give_back()


def _item_windows(window: int, literals: int):
    def run(batches):
        for ids, texts in _chunks(batches):
            words = np.bincount(template(texts)[0], minlength=len(texts))
            long = [t if n >= window else b"" for t, n in zip(texts, words.tolist(), strict=True)]
            yield _batch(ids, *windows(long, [(window, literals)]))
            for n in range(MIN_WORDS, window):
                whole = [t if k == n else b"" for t, k in zip(texts, words.tolist(), strict=True)]
                if any(whole):
                    yield _batch(ids, *windows(whole, [(n, n * literals // window)]))

    return run


def _doc_windows(lengths: list[tuple[int, int]], bitmap: np.ndarray):
    def run(batches):
        for ids, texts in _chunks(batches):
            (text, pos, n, hashed, a, b), values = windows(texts, lengths)
            bit = (hashed >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
            hit = np.flatnonzero(bitmap[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1))
            if len(hit):
                yield _batch(ids, (text[hit], pos[hit], n[hit], hashed[hit], a[hit], b[hit]), values)

    return run


def _bitmap(items: DataFrame) -> np.ndarray:
    """2**BITMAP_BITS bits, a bit per leading part of a hash; the driver gets 2**(BITMAP_BITS - 6) rows at most."""
    bit = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)
    cells = items.groupBy(F.shiftright(bit, 6).alias("cell")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITMAP_BITS}) & 63 as int))")).alias("bits"))
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    for row in cells.collect():
        out[row["cell"]] = row["bits"] & (2**64 - 1)
    return out


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_literals: int = MIN_LITERALS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_windows, first_word, last_word, reparameterised) for every document and item that match."""
    named = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].cast("string").alias("text"))
    items = benchmark.select(benchmark[item_col].cast("bigint").alias("id"), benchmark[item_text_col].cast("string").alias("text"))
    items = items.mapInArrow(_item_windows(window, min_literals), _SCHEMA)
    lengths = [(r["n"], r["n"] * min_literals // window) for r in items.select("n").distinct().orderBy("n").collect()]
    hits = named.mapInArrow(_doc_windows(lengths, _bitmap(items)), _SCHEMA)
    mine = items.select(F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), "hash", F.col("slots").alias("item_slots"))
    pairs = F.transform(F.arrays_zip("item_slots", "slots"), lambda z: F.struct(z["item_slots"].alias("item"), z["slots"].alias("doc")))
    met = hits.join(mine, "hash").select(F.col("id").alias("doc_id"), "item_id", "pos", "item_pos", (F.col("pos") - F.col("item_pos")).alias("diagonal"), pairs.alias("pairs"))
    lines = met.groupBy("doc_id", "item_id", "diagonal").agg(
        F.size(F.collect_set("item_pos")).alias("n"),  # an item's windows at most
        F.size(F.collect_set(F.when(F.size("pairs") == 0, F.col("item_pos")))).alias("plain"),
        F.min("pos").alias("first_word"),
        F.max("pos").alias("last_word"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),  # an item's slots at most
    )
    steady = F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"]))) == F.size("pairs")
    good = lines.withColumn("n_windows", F.when(steady, F.col("n")).otherwise(F.col("plain"))).where("n_windows > 0")
    return good.groupBy("doc_id", "item_id").agg(
        F.sum("n_windows").cast("bigint").alias("n_windows"),
        F.min("first_word").cast("bigint").alias("first_word"),
        F.max("last_word").cast("bigint").alias("last_word"),
        F.bool_or(F.exists("pairs", lambda p: p["item"] != p["doc"])).alias("reparameterised"),
    )
