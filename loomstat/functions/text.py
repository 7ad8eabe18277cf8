"""Cleaning and splitting text, as column expressions over the whole text."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define the cleaner.
MARKUP = r"<[^>]*>"
EMOTICON = r"(?::|;|=)(?:-)?(?:\)|\(|D|P)"
NON_WORD = r"[^\p{L}\p{N}_]+"

# Common English function words, the default stop list.
STOP_WORDS = tuple(
    """
    a about above after again against all am an and any are as at be because
    been before being below between both but by can could did do does doing
    down during each few for from further had has have having he her here hers
    herself him himself his how i if in into is it its itself just me more most
    my myself no nor not now of off on once only or other our ours ourselves
    out over own same she should so some such than that the their theirs them
    themselves then there these they this those through to too under until up
    very was we were what when where which while who whom why will with would
    you your yours yourself yourselves
    """.split()
)


def strip_markup(text: Column) -> Column:
    return F.regexp_replace(text, MARKUP, "")


def emoticons(text: Column) -> Column:
    """All emoticons in order of appearance, as an array."""
    return F.regexp_extract_all(text, F.lit(EMOTICON), 0)


def words_only(text: Column) -> Column:
    """Lower case, every run of other characters than letters, digits and _ one space."""
    return F.regexp_replace(F.lower(text), NON_WORD, " ")


def append_emoticons(text: Column, found: Column) -> Column:
    """Put the emoticons, without their hyphens, behind the text."""
    noseless = F.transform(found, lambda e: F.replace(e, F.lit("-"), F.lit("")))
    return F.concat(text, F.lit(" "), F.array_join(noseless, " "))


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Characters and their replacements for ``translate``, found by rule.

    A character stands for its canonical decomposition without the marks
    (Unicode categories M*), composed again.  Marks themselves come last and
    have no partner, so that ``translate`` deletes them.
    """
    changed, bases, marks = [], [], []
    for code in range(0xA0, sys.maxunicode + 1):
        ch = chr(code)
        category = unicodedata.category(ch)
        if category in ("Cs", "Cn", "Co"):
            continue
        kept = "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c)[0] != "M")
        kept = unicodedata.normalize("NFC", kept)
        if not kept:
            marks.append(ch)
        elif kept != ch:
            changed.append(ch)
            bases.append(kept)
    return "".join(changed + marks), "".join(bases)


def strip_accents(text: Column) -> Column:
    """Drop accents and other marks.  Plain ASCII text skips the table."""
    matching, replacing = _accent_table()
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, matching, replacing)).otherwise(text)


def clean(text: Column) -> Column:
    """The document cleaner: markup, emoticons, words, accents, in that order."""
    plain = strip_markup(text)
    joined = append_emoticons(words_only(plain), emoticons(plain))
    return F.trim(strip_accents(joined))


def tokens(text: Column) -> Column:
    """Split on white space; an empty text has no tokens."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def word_tokens(text: Column) -> Column:
    """Lower-case word tokens of raw text: those of ``words_only``, cut out in one pass over the text."""
    return F.array_remove(F.split(F.lower(text), NON_WORD), F.lit(""))


def without_stop_words(token_array: Column, stop_words=STOP_WORDS) -> Column:
    """Keep the other tokens, repeats included."""
    stop = list(stop_words)
    return F.filter(token_array, lambda t: ~t.isin(stop))
