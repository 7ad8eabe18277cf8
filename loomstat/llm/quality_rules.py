"""Quality rules: clean line by line, then reject documents that lose too much.

A line fails as *navigation* (two or more bars or arrows, at least one to five words), as
*boilerplate* (stock phrases make up ``MIN_STOCK_PERCENT`` of it), or by its *punctuation*: too many symbols, shouting (no lower-case letter
among ten or more capitals), or a short fragment without closing punctuation.
Failed lines go; a document is kept when it passes the base limits and at least
``min_kept_percent`` of its characters stay.

NULL and empty texts have no words and are rejected.  Rows are judged one by one:
repeated rows and ties get equal verdicts, NULL ids stay NULL, other columns are not
read.  There is no shuffle, and nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm.expr import SPACE, let, text_of, words_of

SYMBOLS = r"[#*$%&|<>]"
NAVIGATION = r"(\|[^|]*\|)|(»[^»]*»)|(›[^›]*›)"
NOT_BARS = "[^|»›]"
#: Stock phrases, compared in lower case.
BOILERPLATE = (
    "lorem ipsum", "enable javascript", "cookie policy", "cookies policy", "privacy policy", "terms of use", "terms of service",
    "all rights reserved", "released under the", "licensed under", "click here", "sign up for", "subscribe to", "share this",
)
CLOSING = tuple(".!?:;…\"'”’»)]")
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_KEPT_PERCENT = 50, 50, 50
MAX_SYMBOL_PERCENT, FRAGMENT_WORDS = 10, 6
WORDS_PER_BAR, MIN_STOCK_PERCENT = 5, 15


def repeated_words(words: Column, hashed: Callable[..., Column] = F.xxhash64) -> Column:
    """Words inside a three-word window that the same text holds twice or more.

    Each window becomes one long: its hash above, its position below (as many bits as
    the position needs).  One sort brings equal windows together, so the work is
    n log n in the words and no pair of windows is compared twice.  Windows of equal keys
    are compared word by word; where two differ, the text is counted over by its words.
    """

    def shifted(name: str, value: Column, bits: Column) -> Column:
        return F.call_function(name, value, bits)

    def keys_of(bits: Column) -> Column:
        def key(i: Column) -> Column:
            window = hashed(words[i], words[i + 1], words[i + 2])
            return shifted("shiftleft", window, bits).bitwiseOR(i.cast("bigint"))

        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), key))

    def neighbours(keys: Column) -> Column:
        return F.sequence(F.lit(0), F.size(keys) - 2)

    def covered(twins: Column, position: Callable[[Column], Column]) -> Column:
        hits = F.flatten(F.transform(twins, lambda i: F.array(position(i), position(i + 1))))
        return F.size(F.array_distinct(F.flatten(F.transform(hits, lambda p: F.array(p, p + 1, p + 2)))))

    def by_words() -> Column:
        def count(windows: Column) -> Column:
            twins = F.filter(neighbours(windows), lambda i: windows[i]["w"] == windows[i + 1]["w"])
            return covered(twins, lambda i: windows[i]["i"].cast("bigint"))

        window = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(F.slice(words, i + 1, 3).alias("w"), i.alias("i")))
        return let(F.sort_array(window), count)

    def by_keys(keys: Column, bits: Column) -> Column:
        def position(i: Column) -> Column:
            return keys[i] - shifted("shiftleft", shifted("shiftright", keys[i], bits), bits)

        def same_key(i: Column) -> Column:
            return shifted("shiftright", keys[i].bitwiseXOR(keys[i + 1]), bits) == 0

        def same_words(i: Column) -> Column:
            def equal(p: Column, q: Column) -> Column:
                return (words[p] == words[q]) & (words[p + 1] == words[q + 1]) & (words[p + 2] == words[q + 2])

            return equal(position(i).cast("int"), position(i + 1).cast("int"))

        twins = F.filter(neighbours(keys), same_key)
        return let(twins, lambda t: F.when(F.forall(t, same_words), covered(t, position)).otherwise(by_words()))

    bits_needed = F.length(F.bin(F.size(words).cast("bigint")))  # positions are below the size
    count = let(bits_needed, lambda bits: let(keys_of(bits), lambda keys: by_keys(keys, bits)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(count)


def line_passes(has_symbols: Column) -> Callable[[Column], Column]:
    """True when none of the line rules fails; the cheap part of each rule comes first."""

    def passes(line: Column) -> Column:
        bars = F.length(F.regexp_replace(line, NOT_BARS, ""))
        navigation = (line.contains("|") | line.contains("»") | line.contains("›")) & line.rlike(NAVIGATION) & (bars * WORDS_PER_BAR >= F.size(words_of(line)))

        def stock(low: Column) -> Column:
            found = F.length(low) - F.length(F.regexp_replace(low, "|".join(BOILERPLATE), ""))
            return reduce(Column.__or__, [low.contains(p) for p in BOILERPLATE]) & (found * 100 >= F.length(low) * MIN_STOCK_PERCENT)

        boilerplate = let(F.lower(line), stock)
        bare = F.length(F.regexp_replace(line, SPACE, ""))
        symbols = F.length(line) - F.length(F.regexp_replace(line, SYMBOLS, ""))
        symbolic = has_symbols & (symbols * 100 > bare * MAX_SYMBOL_PERCENT)
        shouting = line.rlike(r"^[^\p{Ll}]*$") & line.rlike(r"(\p{Lu}[^\p{Lu}]*){10}")
        closed = F.substring(F.rtrim(line, F.lit(" \t\n\f\r")), -1, 1).isin(*CLOSING)
        fragment = ~closed & ~line.rlike(rf"([^ \t\n\x0B\f\r]+{SPACE}+){{{FRAGMENT_WORDS - 1}}}[^ \t\n\x0B\f\r]")
        return ~(navigation | boilerplate | symbolic | shouting | fragment)

    return passes


def judgement(
    text: Column, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, min_kept_percent: int = MIN_KEPT_PERCENT
) -> Column:
    """struct<counts, base_failed, kept, clean_text> of a text that is not NULL."""

    def verdict(words: Column, lines: Column, joined: Column, n_symbols: Column) -> Column:
        def struct(good: Column, repeats: Column) -> Column:
            n = F.size(words)
            failed = (n < min_words) | (repeats * 100 > n * max_repeat_percent)
            enough = F.length(F.array_join(good, "")) * 100 >= F.length(F.array_join(lines, "")) * min_kept_percent
            return F.struct(
                n.cast("bigint").alias("n_words"),
                F.length(joined).cast("bigint").alias("word_chars"),
                n_symbols.cast("bigint").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
                repeats.cast("bigint").alias("n_repeat_words"),
                failed.alias("base_failed"),
                (~failed & enough).alias("kept"),
                F.array_join(good, "\n").alias("clean_text"),
            )

        return let(F.filter(lines, line_passes(n_symbols > 0)), lambda good: let(repeated_words(words), lambda n: struct(good, n)))

    def judged(text: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))

        def counted(w: Column) -> Column:
            n_symbols = let(F.array_join(w, ""), lambda j: F.struct(j.alias("j"), (F.length(j) - F.length(F.regexp_replace(j, SYMBOLS, ""))).alias("n")))
            return let(lines, lambda ls: let(n_symbols, lambda s: verdict(w, ls, s["j"], s["n"])))

        return let(words_of(text), counted)

    return let(text, judged)


def assess(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    min_kept_percent: int = MIN_KEPT_PERCENT,
) -> DataFrame:
    """Per row: the id, the counts, ``base_failed``, ``kept`` and ``clean_text`` (passing lines)."""

    judged = judgement(text_of(docs, text_col), min_words, max_repeat_percent, min_kept_percent)
    return docs.select(docs[id_col].alias("doc_id"), judged.alias("v")).select("doc_id", "v.*")


def cleaned(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The kept rows with all their columns, failed lines taken out and ``size_col`` counted anew."""
    verdict = "_verdict"
    while verdict in docs.columns:
        verdict += "_"
    # explode() keeps the verdict from being worked out once for the filter and once for the text
    passing = F.filter(F.array(judgement(text_of(docs, text_col))), lambda v: v["kept"])
    kept = docs.select("*", F.explode(passing).alias(verdict))
    out = kept.withColumn(text_col, F.col(verdict)["clean_text"]).drop(verdict)
    return out.withColumn(size_col, F.length(text_col).cast("bigint")) if size_col in docs.columns else out
