"""Personal data: regular expressions propose, checksums confirm, context adjusts the score.

Base kinds (``email ip card phone``) follow their stated patterns.  Added kinds:
``iban`` (mod-97) and ``shortcard`` (13 to 15 digits passing Luhn, only when a word such
as "card" stands in the 40 characters before it, back to the match before).  Positions are code points, end
exclusive.  The patterns are written so that Java's matcher takes linear time and no
recursion on very long runs; they match what the plain ones match.

NULL texts count as empty and have no spans; rows are judged one by one, so repeated
rows, NULL ids and empty tables need nothing special; other columns are not read.
There is no shuffle and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.expr import let, text_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "shortcard")
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: A run of digits with single spaces or hyphens inside, taken whole, of a given number of digits.
_DIGITS = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){{{0},{1}}}+(?![ -]?[0-9])"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": _DIGITS.format(15, 18),
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b",
    "shortcard": _DIGITS.format(12, 14),
}
#: What a text must hold before the costlier search of a kind starts.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "address|host|server|ip",
    "card": "card|visa|credit|payment|pay",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|transfer",
    "shortcard": "card|visa|credit|payment|amex",
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "shortcard": 0.3}
BOOST, THRESHOLD, REACH = 0.3, 0.5, 40
_HIT = "array<struct<start:int,end:int,hit:string,before:string>>"


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True when a string of digits passes the Luhn check."""

    def step(acc: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(hit: Column) -> Column:
    """True when an account number passes the mod-97 check."""
    bare = F.replace(hit, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        letter = F.ascii(c) >= 65
        value = F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return (acc * F.when(letter, 100).otherwise(10) + value) % 97

    return F.aggregate(F.array_remove(F.split(turned, ""), ""), F.lit(0), step) == 1


def _small(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))


CHECKS = {
    "email": lambda hit: F.lit(True),
    "ip": lambda hit: F.forall(F.split(hit, r"\."), _small),
    "card": lambda hit: luhn(digits_of(hit)),
    "phone": lambda hit: F.length(digits_of(hit)).between(8, 15),
    "iban": mod97,
    "shortcard": lambda hit: luhn(digits_of(hit)),
}


def _found(text: Column, pattern: str) -> Column:
    """Every match with its place: the pieces between matches give the positions."""
    none = F.array().cast(_HIT)

    def placed(hits: Column, pieces: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["pos"] + F.length(pieces[i])
            end = start + F.length(hits[i])
            hit = F.struct(start.alias("start"), end.alias("end"), hits[i].alias("hit"), F.substring(pieces[i], -REACH, REACH).alias("before"))
            return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(hit)).alias("out"))

        begin = F.struct(F.lit(0).alias("pos"), none.alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), begin, step)["out"]

    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda hits: F.when(F.size(hits) == 0, none).otherwise(let(F.split(text, pattern), lambda p: placed(hits, p))),
    )


def _spans(text: Column, kind: str) -> Column:
    hits = _found(text, PATTERNS[kind])
    if kind in NEEDS:
        hits = F.when(F.contains(text, F.lit(NEEDS[kind])), hits).otherwise(F.array().cast(_HIT))
    checked = F.filter(hits, lambda h: CHECKS[kind](h["hit"]))
    scored = F.transform(
        checked,
        lambda h: F.struct(
            F.lit(kind).alias("kind"),
            h["start"].alias("start"),
            h["end"].alias("end"),
            h["hit"].alias("hit"),
            F.least(
                F.lit(1.0),
                F.lit(PRIOR[kind]) + F.when(F.lower(h["before"]).rlike(rf"\b({CONTEXT[kind]})"), F.lit(BOOST)).otherwise(F.lit(0.0)),
            ).alias("score"),
        ),
    )
    return F.filter(scored, lambda s: s["score"] >= THRESHOLD)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and ``spans`` array<struct<kind,start,end,hit,score>>, by kind as listed, then start."""

    def all_spans(text: Column) -> Column:
        return F.concat(*[_spans(text, k) for k in KINDS])

    return docs.select(docs[id_col].alias("doc_id"), let(text_of(docs, text_col), all_spans).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[KIND]``; overlapping spans become one."""

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["pos"]
        part = F.array(F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(
            F.greatest(acc["pos"], s["end"]).alias("pos"),
            F.when(fresh, F.concat(acc["out"], part)).otherwise(acc["out"]).alias("out"),
        )

    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    ends = F.aggregate(ordered, begin, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, 2147483647)))
    return F.when(F.size(spans) == 0, text).otherwise(ends)
