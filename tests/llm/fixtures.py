"""Small documents with every odd case: NULLs, empties, repeats, very long texts, clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, key string, fp bigint, spans string, kind string, label string, h string"
WORDS = "river stone garden window travel simple number history market letter paper voice mountain silver forest winter doctor bridge".split()


def prose(seed: int, words: int) -> str:
    """Sentences of ten random words."""
    rng = random.Random(seed)
    made = [rng.choice(WORDS) + rng.choice(WORDS) + str(rng.choice("aeiou")) for _ in range(words)]
    return " ".join(w.capitalize() if i % 10 == 0 else w + "." if i % 10 == 9 else w for i, w in enumerate(made)) + "."


def rows(texts):
    """(doc_id, text) pairs as rows with clashing extra columns, some of them NULL."""
    return [(i, t, "en", None, None if t is None else len(t), 5, None, 7, "x", None, "y", None) for i, t in texts]


def odd_texts():
    base = prose(1, 200)
    edited = base.replace(base.split()[100], "changed", 1)
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, base),
        (5, base),
        (6, edited),
        (6, edited),
        (7, prose(2, 20000)),
        (8, "é" * 30 + "日本語のテキスト" * 40),
        (9, "a" * 3000),
        (10, "ab" * 900),
        (11, "x" + prose(3, 30) + base[200:700] + prose(4, 30)),
        (None, prose(5, 80)),
        (None, None),
        (12, "no"),
    ]


def documents(spark, texts):
    return spark.createDataFrame(rows(texts), SCHEMA)
