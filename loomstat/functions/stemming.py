"""English stemmer for single words (the published Porter2 rules).

Spark has no stemmer.  Callers run this on distinct terms only.
"""

from __future__ import annotations

import re

# Words with stems of their own, and words that stay as they are.
SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
}
UNCHANGED = {"sky", "news", "howe", "atlas", "cosmos", "bias", "andes"}
UNCHANGED_AFTER_PLURAL = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
LONG_PREFIX = re.compile(r"^(gener|commun|arsen)")

# Suffixes and what replaces them, by step.
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
    "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
    "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": "",
}
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split()
)

_VOWEL = "aeiouy"
_REGION = re.compile(rf"[{_VOWEL}][^{_VOWEL}]")
_SHORT_END = re.compile(rf"(^[{_VOWEL}][^{_VOWEL}]|[^{_VOWEL}][{_VOWEL}][^{_VOWEL}wxY])$")
_HAS_VOWEL = re.compile(rf"[{_VOWEL}]")


def _longest(word: str, suffixes) -> str | None:
    found = [s for s in suffixes if word.endswith(s)]
    return max(found, key=len) if found else None


def _regions(word: str) -> tuple[int, int]:
    """Where R1 and R2 start: behind the first (second) consonant that follows a vowel."""
    prefix = LONG_PREFIX.match(word)
    first = _REGION.search(word)
    r1 = prefix.end() if prefix else first.end() if first else len(word)
    second = _REGION.search(word, r1)
    return r1, second.end() if second else len(word)


def _plural(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith(("ied", "ies")):
        return w[:-2] if len(w) > 4 else w[:-1]
    if w.endswith("s") and not w.endswith(("us", "ss")) and _HAS_VOWEL.search(w[:-2]):
        return w[:-1]
    return w


def _past(w: str, r1: int) -> str:
    end = _longest(w, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if end is None:
        return w
    base = w[: -len(end)]
    if end in ("eed", "eedly"):
        return base + "ee" if len(base) >= r1 else w
    if not _HAS_VOWEL.search(base):
        return w
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if len(base) > 1 and base[-1] == base[-2] and base[-1] in "bdfgmnprt":
        return base[:-1]
    return base + "e" if _SHORT_END.search(base) and len(base) <= r1 else base


def _derived(w: str, r1: int, r2: int) -> str:
    end = _longest(w, STEP_2)
    if end and len(w) - len(end) >= r1:
        base = w[: -len(end)]
        if not (end == "ogi" and not base.endswith("l")) and not (end == "li" and (not base or base[-1] not in "cdeghkmnrt")):
            w = base + STEP_2[end]
    end = _longest(w, STEP_3)
    if end and len(w) - len(end) >= (r2 if end == "ative" else r1):
        w = w[: -len(end)] + STEP_3[end]
    end = _longest(w, STEP_4)
    if end and len(w) - len(end) >= r2 and not (end == "ion" and w[-4:-3] not in ("s", "t")):
        w = w[: -len(end)]
    return w


def english_stem(word: str) -> str:
    if len(word) <= 2 or word in UNCHANGED:
        return word
    if word in SPECIAL:
        return SPECIAL[word]
    w = word.lstrip("'")
    w = re.sub(rf"(^|[{_VOWEL}])y", r"\1Y", w)
    r1, r2 = _regions(w)
    w = re.sub(r"('s'|'s|')$", "", w)
    w = _plural(w)
    if w in UNCHANGED_AFTER_PLURAL:
        return w
    w = _past(w, r1)
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWEL:
        w = w[:-1] + "i"
    w = _derived(w, r1, r2)
    if w.endswith("e") and (len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _SHORT_END.search(w[:-1]))):
        w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.replace("Y", "y")
