"""Secret scan: stated patterns, and a randomness test battery for strings without one.

Base kinds (``assign access hex``) follow their patterns.  Added kind ``random``: a run
of 20 or more symbols whose encoding is inferred (hex, base32, base64, or plain letters
and digits, of one case or both), which no base kind ``hex`` holds, and which

* the battery cannot tell from uniform draws of that alphabet: chi-squared counts, runs
  above and below the middle, lag-one serial correlation (Bonferroni over the three);
* ordinary text would hardly make: changes between character classes are counted
  against a binomial for text, whose tail takes the length into account.  Strings of one
  case change class less, so for them the tail of the rare letters joins it by Fisher's
  rule.  The p-values (1 for strings that fail the battery) are under a
  Benjamini-Hochberg control over the whole corpus, held in bands of length, from a
  histogram of fixed size.

Positions are code points, end exclusive.  NULL texts are empty; rows are judged one by
one but for the corpus-wide control, where repeated rows count repeatedly; NULL ids and
empty tables need nothing special; other columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.blocks import rows_of
from loomstat.session import cut_lineage

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]{16,}")
WORDS = ("passw", "secret", "token", "api_key", "apikey")
CANDIDATE = re.compile("[A-Za-z0-9+/_-]{20,}={0,2}")
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("hex", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("letters", "abcdefghijklmnopqrstuvwxyz"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "abcdefghijklmnopqrstuvwxyz234567"),
    ("alnum", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
)
#: The battery's level, the share of class changes in ordinary text, the false-discovery rate.
LEVEL, TEXT_CHANGES, FDR = 1e-3, 0.12, 0.01
#: Letters that make up no more than this share of English, German, French and Spanish text.
RARE_LETTERS, TEXT_RARE = frozenset("bfgjkpqvwxyz"), 0.16
#: Bands of length begin here; p-values are held in bins of a quarter decade.
BANDS, BINS_PER_DECADE, BINS = (20, 24, 32, 48, 64, 128), 4, 120
_FOUND = "doc_id long, base array<struct<kind:string,start:int,end:int>>, candidates array<struct<start:int,end:int,band:int,bin:int,passes:boolean>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the stated patterns."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS) or not low.isascii():
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def inferred(symbols: str) -> tuple[str, str] | None:
    """The smallest alphabet that holds all symbols."""
    used = set(symbols)
    return min((a for a in ALPHABETS if used <= set(a[1])), key=lambda a: len(a[1]), default=None)


def battery(symbols: str, alphabet: str) -> float:
    """The smallest of three p-values, times three: small when the symbols are not uniform draws."""
    value = np.array([alphabet.index(c) for c in symbols])
    n, size = len(value), len(alphabet)
    counts = np.bincount(value, minlength=size)
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    z = (chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    uniform = 0.5 * math.erfc(z / math.sqrt(2))
    high = value >= size / 2
    up = int(high.sum())
    down = n - up
    if up and down:
        mean = 2 * up * down / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        runs = _two_sided((1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        runs = 0.0
    centred = value - value.mean()
    power = float((centred**2).sum())
    serial = _two_sided((float((centred[1:] * centred[:-1]).sum()) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    return min(1.0, 3 * min(uniform, runs, serial))


def _tail(n: int, hits: int, share: float) -> float:
    """How likely ``hits`` or more of ``n`` are, at this share each."""
    tail = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log(1 - share) for k in range(hits, n + 1)]
    top = max(tail)
    return min(1.0, math.exp(top) * sum(math.exp(t - top) for t in tail)) if top > -690 else 0.0


def text_tail(symbols: str) -> float:
    """How likely ordinary text of this length has so many changes of character class (and, in one case, rare letters)."""
    kind = [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in symbols]
    changes = _tail(len(kind) - 1, sum(a != b for a, b in zip(kind, kind[1:], strict=False)), TEXT_CHANGES)
    if not (symbols.islower() or symbols.isupper()):
        return changes
    both = changes * _tail(sum(k < 2 for k in kind), sum(c in RARE_LETTERS for c in symbols.lower()), TEXT_RARE)
    return both * (1 - math.log(both)) if both > 0 else 0.0


def _candidates(text: str) -> list[dict]:
    out = []
    for m in CANDIDATE.finditer(text):
        symbols = m[0].rstrip("=")
        if HEX.fullmatch(symbols):  # the base kind holds it
            continue
        alphabet = inferred(symbols)
        tail = text_tail(symbols)
        step = min(BINS, int(-math.log10(tail) * BINS_PER_DECADE)) if tail > 0 else BINS
        out.append(
            {
                "start": m.start(),
                "end": m.end(),
                "band": sum(len(symbols) >= b for b in BANDS) - 1,
                "bin": step,
                "passes": alphabet is not None and battery(symbols, alphabet[1]) >= LEVEL,
            }
        )
    return out


def _scan(batches):
    for batch in batches:
        base, more = [], []
        for _, text in rows_of(batch):
            base.append([{"kind": BASE[k], "start": a, "end": b} for a, k, b in base_spans(text or "")])
            more.append(_candidates(text or ""))
        span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        candidate = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("band", pa.int32()), ("bin", pa.int32()), ("passes", pa.bool_())])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.list_(span)), pa.array(more, pa.list_(candidate))], ["doc_id", "base", "candidates"])


def _limits(candidates: DataFrame, rate: float) -> dict[int, int]:
    """band -> the first bin whose p-values the Benjamini-Hochberg rule accepts."""
    counts: dict[int, dict[int, tuple[int, int]]] = {}
    cells = candidates.groupBy("c.band", "c.bin").agg(F.count("*").alias("n"), F.count_if("c.passes").alias("passing"))
    for r in cells.collect():  # bands x bins rows at most
        counts.setdefault(r["band"], {})[r["bin"]] = (r["n"], r["passing"])
    limits = {}
    for band, bins in counts.items():
        total, kept = sum(n for n, _ in bins.values()), 0
        for step in sorted(bins, reverse=True):
            kept += bins[step][1]
            if 10.0 ** (-step / BINS_PER_DECADE) * total <= rate * kept:
                limits[band] = step
    return limits


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FDR) -> DataFrame:
    """Per row: ``doc_id`` and ``spans`` array<struct<start, rank, end, kind>>, by start, then kind as listed."""
    named = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    found = cut_lineage(named.mapInArrow(_scan, _FOUND))
    limits = _limits(found.select(F.explode("candidates").alias("c")), rate)

    def accepted(c: Column) -> Column:
        limit = F.lit(BINS + 1)
        for band, step in limits.items():
            limit = F.when(c["band"] == band, F.lit(step)).otherwise(limit)
        return c["passes"] & (c["bin"] >= limit)

    def span(start: Column, rank: Column, end: Column, kind: Column) -> Column:
        return F.struct(start.alias("start"), rank.alias("rank"), end.alias("end"), kind.alias("kind"))

    base = F.transform("base", lambda s: span(s["start"], F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("int"), s["end"], s["kind"]))
    more = F.transform(F.filter("candidates", accepted), lambda s: span(s["start"], F.lit(len(KINDS)), s["end"], F.lit(KINDS[-1])))
    return found.select("doc_id", F.sort_array(F.concat(base, more)).alias("spans"))
