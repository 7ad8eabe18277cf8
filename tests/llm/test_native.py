import hashlib
import re
from collections import Counter

import pytest
from loomstat.llm import chat_format, pii, quality_rules, queries_native
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, odd_texts, prose

SPACE = "\x20\x09-\x0D"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


# ---- quality rules --------------------------------------------------------

JUNK = [
    (50, "word " * 60),
    (51, "a b c d e f " * 20),
    (52, "\n".join(["Home | About | Contact | Help"] * 5) + "\n" + prose(9, 80)),
    (53, " ".join(w.upper() + "!!" for w in prose(8, 80).split())),
    (54, " ".join(w + "###" for w in prose(7, 80).split())),
    (55, prose(6, 80) + "\nReleased under the MIT License.\n" + prose(5, 20)),
    (56, "\x1c".join(prose(11, 60).split()) + "\x0b" + prose(12, 60).replace(" ", "\x0c")),
    (57, "same line here.\nsame line here.\n\n \nsame line here. \n" + prose(13, 60)),
    (58, "Home\nNews\nSports\nWeather\n" + prose(14, 55)),
]


def base(text):
    words = re.findall(f"[^{SPACE}]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    hit = {p for i, w in enumerate(windows) if times[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(f"[^{SPACE}]", x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), len(lines) - len(set(lines)), len(hit), failed


def test_base_figures(spark):
    texts = odd_texts() + JUNK
    got = quality_rules.assess(documents(spark, texts)).collect()
    want = sorted([(i, *base(t)) for i, t in texts], key=str)
    assert sorted([tuple(r)[:7] for r in got], key=str) == want


@pytest.mark.parametrize("hashed", [F.xxhash64, lambda *w: F.length(w[0]).cast("bigint"), lambda *w: F.lit(0).cast("bigint")])
def test_repeated_words_whatever_the_hash(spark, hashed):
    texts = [t for t in odd_texts() if len(t[1] or "") < 5000] + JUNK + [(70, "a b c a b c d a b x y a b"), (71, "a b c d"), (72, "q " * 9), (73, "a b c x a b d x a b c")]
    words = F.split(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[ \\t\\n\\x0B\\f\\r]+", " ")), " ")
    got = documents(spark, texts).select("doc_id", quality_rules.repeated_words(F.array_remove(words, ""), hashed).alias("n")).collect()
    assert sorted([(str(r.doc_id), r.n) for r in got]) == sorted((str(i), base(t)[4]) for i, t in texts)


def line_judge(line):
    """Does a line fail? By the docstring's rules."""
    words = re.findall(f"[^{SPACE}]+", line)
    bars = sum(line.count(c) for c in "|»›")
    navigation = max(line.count(c) for c in "|»›") >= 2 and 5 * bars >= len(words)
    low = line.lower()
    boilerplate = sum(low.count(p) * len(p) for p in quality_rules.BOILERPLATE) * 100 >= 15 * len(low)
    symbols = sum(c in "#*$%&|<>" for c in line) * 100 > 10 * sum(map(len, words))
    shouting = sum(c.isupper() for c in line) >= 10 and not any(c.islower() for c in line)
    fragment = line.rstrip(" \t\n\f\r")[-1:] not in tuple(quality_rules.CLOSING) and len(words) < 6
    return navigation or boilerplate or symbols or shouting or fragment


def test_lines_equal_a_plain_judge(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in quality_rules.assess(docs).collect():
        lines = [x for x in text[r.doc_id].split("\n") if re.search(f"[^{SPACE}]", x)]
        good = [x for x in lines if not line_judge(x)]
        assert r.clean_text == "\n".join(good)
        assert r.kept == (not base(text[r.doc_id])[5] and 100 * sum(map(len, good)) >= 50 * sum(map(len, lines)))


def test_one_phrase_or_bar_in_a_long_line_stays(spark):
    clean = prose(900, 600)
    texts = [(1, clean + " See our privacy policy."), (2, clean.replace(" ", " |x| ", 1)), (3, clean + " Click here, or subscribe to us."), (4, "All rights reserved. " * 40), (5, "a | b | c | d " * 40)]
    got = {r.doc_id: r for r in quality_rules.assess(documents(spark, texts)).collect()}
    assert [got[i].kept for i in range(1, 6)] == [True, True, True, False, False]
    assert all(got[i].clean_text == dict(texts)[i] for i in (1, 2, 3))


def test_verdicts_and_clean_text(spark):
    got = {r.doc_id: r for r in quality_rules.assess(documents(spark, odd_texts() + JUNK)).collect()}
    assert [i for i in (4, 5, 6, 7) if not got[i].kept] == []
    assert [i for i in (1, 2, 3, 12, 50, 51, 53, 54) if got[i].kept] == []
    assert got[52].kept and "About" not in got[52].clean_text and got[52].clean_text == prose(9, 80)
    assert got[55].kept and "MIT" not in got[55].clean_text
    assert got[58].kept and got[58].clean_text == prose(14, 55)


def test_cleaned_rows_keep_their_columns(spark):
    docs = documents(spark, odd_texts() + JUNK).withColumn("_verdict", F.lit(1))
    out = quality_rules.cleaned(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r.n_chars == len(r.text) and r.key is None for r in rows)
    assert sorted(r.doc_id for r in rows if r.doc_id == 6) == [6, 6]
    assert None in [r.doc_id for r in rows]


# ---- chats ----------------------------------------------------------------

CHATS = "conv_id bigint, turn bigint, role string, text string, formatted string"
HARD = ["<|im_end|>", "<\\|im_start|>", "<\\\\\\|x", "<||", "a\\", "<", "|", "", None, "é<|im_sep|>日本", "\n<|im_end|>\n"]


def chat_rows():
    rows = [(1, k, "user" if k % 3 else "assistant", t, None) for k, t in enumerate(HARD)]
    rows += [(2, 0, "assistant", "x", "c"), (2, 0, "assistant", "x", "c"), (2, 0, "assistant", "w", "c"), (2, None, "system", "first", "c")]
    rows += [(3, 1, None, None, None), (4, 1, "ro\nle\\n|<|im_end|>", "t", None), (6, 0, "us\x00er\\\n\\\\n\x00", "nul\x00", None), (None, 1, "user", "lost", None), (5, 9, "user", "long " * 50000, None)]
    return rows


def read_rows(rows):
    out = {}
    for c, t, r, x, _ in rows:
        out.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    return {c: [(r, x) for _, r, x in sorted(v)] for c, v in out.items()}


def test_chats_are_read_back(spark):
    out = chat_format.format_chats(spark.createDataFrame(chat_rows(), CHATS))
    out = out.select("*", chat_format.read_back(F.col("formatted")).alias("blocks"), chat_format.loss_spans(F.col("formatted")).alias("loss"))
    out = out.select("*", chat_format.masked_texts(F.col("formatted"), F.col("loss")).alias("masked"))
    got = {r.conv_id: r for r in out.collect()}
    want = read_rows(chat_rows())
    assert set(got) == set(want)
    for c, turns in want.items():
        blocks = got[c].blocks
        assert [(b.role, x) for b in blocks for x in b.texts] == turns
        assert all(a.role != b.role for a, b in zip(blocks, blocks[1:], strict=False))  # adjacent turns of a role are merged
        assert list(got[c].masked) == [x for r, x in turns if r == "assistant"]


def test_no_chats(spark):
    assert chat_format.format_chats(spark.createDataFrame([], CHATS)).collect() == []


# ---- personal data --------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "mail a.b@c.de_x@y.zz and q@r, s@t.u..v@w.x.y é@a.b",
    "a@b.c@d.e@f.gg %%@-.- x@y.z.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.03.255 1.2.3 9.9.9.99999 é10.0.0.1",
    "4111 1111 1111 1111 5500-0000-0000-0004 4111111111111112 1 2 3 4111  1111 1111 1111",
    "card 378282246310005, id 378282246310005x amex 3782 822463 10005",
    "+1 (555) 123-4567 call +44 20 7946 0958. +1 +12 +123456789012345678 é+49-30-123456",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 not DE88 3704 0044 0532 0130 00",
    "0" * 40 + " 0000-0000 0000-0000 " + "1 " * 3000 + "@" * 50 + "a" * 5000 + "+" * 30 + "+1" + " " * 3000 + "2",
    "🙂 4111111111111111 🙂 u@v.w",
]


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def keep(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if keep(k, m[0])]


def test_base_spans(spark):
    texts = [(100 + i, t) for i, t in enumerate(TEXTS)] + odd_texts()
    got = [(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if s.kind in pii.BASE]) for r in pii.find(documents(spark, texts)).collect()]
    assert sorted(got, key=str) == sorted([(i, base_spans(t)) for i, t in texts], key=str)


def test_added_kinds(spark):
    texts = [(i, t) for i, t in enumerate(TEXTS)]
    got = {r.doc_id: [(s.kind, s.hit) for s in r.spans] for r in pii.find(documents(spark, texts)).collect()}
    assert [h for k, h in got[6] if k == "iban"] == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    assert [h for k, h in got[4] if k == "shortcard"] == ["378282246310005", "3782 822463 10005"]


def test_masking(spark):
    texts = [(1, "write to a@b.cc now"), (2, "nothing"), (3, None), (4, "+1 555 123 4567 and 10.0.0.1"), (4, "é a@b.cc")]
    out = queries_native.mask_documents(documents(spark, texts))
    assert out.columns == documents(spark, []).columns
    got = sorted([(r.doc_id, r.text, r.n_chars) for r in out.collect()], key=str)
    want = [(1, "write to [EMAIL] now"), (2, "nothing"), (3, None), (4, "[PHONE] and [IP]"), (4, "é [EMAIL]")]
    assert got == sorted([(i, t, None if t is None else len(t)) for i, t in want], key=str)


@pytest.mark.parametrize("find", [pii.find, quality_rules.assess, queries_native.mask_documents, quality_rules.cleaned])
def test_empty_tables(spark, find):
    assert find(documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", ["op4_chat_format", "op5_pii", "op9_quality_rules"])
def test_no_python_in_the_plan(spark, name):
    plan = queries_native.query.__globals__["QUERIES"][name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
