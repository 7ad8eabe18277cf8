import random
import re
from collections import defaultdict

import pytest
from loomstat.llm import decontaminate, queries

from tests.llm.fixtures import documents, odd_texts, prose

ITEMS = "item_id bigint, text string, id bigint, pos int"
QUESTION = "In the market Alice bought 12 green apples for 3 dollars and gave 12 of them to her old friend Bob before the long trip home."
SAME = QUESTION.replace("Alice", "Carol").replace("12", "45").replace("3 dollars", "7 dollars").replace("Bob", "Dan")
BROKEN = QUESTION.replace("bought 12", "bought 45").replace("gave 12", "gave 46").replace("Alice", "Carol")
PASSAGE = prose(70, 60)


def found(spark, texts, items, **options):
    bench = spark.createDataFrame([(i, t, 1, None) for i, t in items], ITEMS)
    rows = decontaminate.find(documents(spark, texts), bench, **options).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


ITEM_ROWS = [(1, QUESTION), (2, PASSAGE), (3, None), (4, ""), (5, "only six words stand right here"), (6, "two words"), (None, prose(71, 40))]


def test_planted_cases(spark):
    texts = [
        (10, prose(80, 50) + "\n" + SAME + "\n" + prose(81, 50)),
        (11, prose(82, 300) + " " + QUESTION.upper() + " " + prose(83, 50)),
        (12, prose(84, 40) + " " + " ".join(PASSAGE.split()[10:30]) + " " + prose(85, 40)),
        (13, prose(86, 200)),
        (14, "he said: Only six words, stand right here! " + prose(87, 20)),
        (15, PASSAGE.replace(" ", "  \n")),
        (15, PASSAGE),
        (16, " ".join(PASSAGE.split()[:8]) + " " + prose(88, 30)),
        (None, PASSAGE),
        *odd_texts(),
    ]
    got = found(spark, texts, ITEM_ROWS)
    assert set(got) == {(10, 1), (11, 1), (12, 2), (14, 5), (15, 2), (None, 2)}
    assert got[10, 1].reparameterised and not got[12, 2].reparameterised
    assert got[12, 2].n_windows == 11 and got[12, 2].last_word - got[12, 2].first_word == 10


def test_slots_must_agree(spark):
    # the windows with both twelves are refused; those without any slot still count
    got = found(spark, [(1, SAME), (2, BROKEN)], [(1, QUESTION)])
    assert (1, 1) in got and got[1, 1].n_windows > got.get((2, 1), got[1, 1]).n_windows or (2, 1) not in got


def told(text):
    """(value, kind) of the words: kind is number, unit, name, opener or None."""
    out, stop = [], True
    for line in (text or "").split("\n"):
        stop = True
        for raw in re.findall(r"[^\x20\x09-\x0D]+", line):
            kept = "".join(c for c in raw if ord(c) > 127 or c.isalnum())
            if not kept:
                continue
            value = "".join(c.lower() if c.isascii() else c for c in kept)
            latin = 0xC0 <= ord(kept[0]) <= 0xDE and ord(kept[0]) != 0xD7
            big = (kept[0].isascii() and kept[0].isupper() and len(kept) > 1 and (not kept[1].isascii() or kept[1].islower())) or latin
            kind = "number" if any(c in "0123456789" for c in raw) else "unit" if value in decontaminate.UNITS else ("opener" if stop else "name") if big else None
            out.append((value, kind))
            stop = raw[-1] in ".!?:;"
    return out


def readings(words, n, literals):
    """{(reading of the window, ...): [(position, slot values)]}, as tuples of words and kinds."""
    out = defaultdict(list)
    for i in range(len(words) - n + 1):
        w = words[i : i + n]
        for slots in ({"number", "unit", "name"}, {"number", "unit", "name", "opener"}, set()):
            gaps = [v for v, k in w if k in slots]
            if slots and n - len(gaps) < literals or "opener" in slots and w[-1][1] == "opener":
                continue
            key = tuple(("?", "name" if k == "opener" else k) if k in slots else ("=", v) for v, k in w)
            if (i, gaps) not in out[key]:
                out[key].append((i, gaps))
    return out


def brute(texts, items, window=10, least=7):
    """{(doc, item): (windows, reparameterised)} by comparing all readings of all windows."""
    result = {}
    for item, question in items:
        words = told(question)
        n = window if len(words) >= window else len(words)
        if n < 5:
            continue
        mine = readings(words, n, n * least // window)
        for doc, text in texts:
            lines = defaultdict(lambda: (set(), set(), set()))
            for key, places in readings(told(text), n, n * least // window).items():
                for p, gaps in places:
                    for q, other in mine.get(key, ()):
                        met, plain, pairs = lines[p - q]
                        met.add(p)
                        pairs.update(zip(other, gaps))
                        if not gaps:
                            plain.add(p)
            total, changed = 0, False
            for met, plain, pairs in lines.values():
                good = met if len({a for a, _ in pairs}) == len(pairs) else plain
                total += len(good)
                changed |= bool(good) and any(a != b for a, b in pairs)
            if total:
                result[doc, item] = (total, changed)
    return result


ALICE = "Alice has 12 apples. Bob gives her 5 more. Carol takes 3 of them. Dan eats 2 pears. How many are left?"
NAMES = "Tom Smith has 12 apples, Ann Lee has 7 pears and Bob Ray has 9 plums."


def test_names_that_open_sentences_and_windows_full_of_names(spark):
    other = ALICE.replace("Alice", "Erin").replace("Bob", "Frank").replace("Carol", "Grace").replace("Dan", "Henry").replace("12", "30").replace("5 more", "8 more").replace("takes 3", "takes 4").replace("2 pears", "6 pears")
    texts = [(1, prose(90, 40) + "\n" + other), (2, prose(91, 30) + " " + NAMES), (3, NAMES.lower()), (4, NAMES.replace("12", "13")), (5, ALICE), (6, prose(92, 80))]
    items = [(1, ALICE), (2, NAMES)]
    got = {k: (r.n_windows, r.reparameterised) for k, r in found(spark, texts, items).items()}
    assert got == brute(texts, items) and {(1, 1), (2, 2), (3, 2), (5, 1)} <= set(got) and not any(d == 6 for d, _ in got)
    assert got[1, 1][1] and not got[5, 1][1] and not got[2, 2][1]


def test_verbatim_copies_of_every_item_of_five_words(spark):
    items = [(1, "Paris Rome Berlin 12 Oslo"), (2, "Ann 1 Bob 2 Cat 3 Dan 4 Eve 5 Flo 6"), (3, "One Two Three Four"), (4, "km kg 3 4 Ann Bob"), *ITEM_ROWS]
    items = [(i, t) for i, t in items if i not in (None,)][:4]
    texts = [(i, prose(94 + i, 20) + " " + t + " " + prose(99 + i, 20)) for i, t in items]
    assert {k for k in found(spark, texts, items)} >= {(1, 1), (2, 2), (4, 4)} and (3, 3) not in found(spark, texts, items)


def test_equals_a_plain_matcher(spark):
    rng = random.Random(3)
    pool = "Alice Bob Carol has have 1 2 30 km kg apples and the red. The River gave? to a".split()
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(4, 24)))) for i in range(24)]
    texts = [(100 + i, " ".join(rng.choice(pool) for _ in range(60))) for i in range(10)]
    for i, t in items:
        words = t.split()
        swap = {w: rng.choice(["Dora", "Emil", "44", "555"]) for w in words if w in ("Alice", "Bob", "1", "30") and rng.random() < 0.5}
        texts.append((200 + i, "some words before it " + " ".join(swap.get(w, w) for w in words) + " and some after"))
    texts += [(None, None), (300, "")]
    got = {k: (r.n_windows, r.reparameterised) for k, r in found(spark, texts, items).items()}
    assert got == brute(texts, items) and len(got) >= 8


def test_brute_force_on_literal_windows(spark):
    """Lower-case texts without digits or units have no slots: windows must be found exactly."""
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    plain = lambda t: [w for w in ("".join(c for c in w if ord(c) > 127 or c.isalnum()) for w in t.lower().split()) if w]
    n = decontaminate.WINDOW
    where = {}
    for i, t in items:
        w = plain(t)
        for k in range(len(w) - n + 1):
            where.setdefault(tuple(w[k : k + n]), set()).add(i)
    want = {(d, i) for d, t in docs for w in [plain(t)] for k in range(len(w) - n + 1) for i in where.get(tuple(w[k : k + n]), ())}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op3_decontamination"](spark, folder).collect()}
    assert got == want


@pytest.mark.parametrize(("texts", "items"), [([], ITEM_ROWS), (odd_texts(), []), ([], [])])
def test_empty_tables(spark, texts, items):
    assert found(spark, texts, items) == {}


def test_template_marks():
    text, token, slot, _, opener = decontaminate.template([b"The Cat saw 12 kg. Then Paris, in", "à École 3km".encode(), b"", b"-- !!"])
    assert text.tolist() == [0] * 8 + [1] * 3
    assert slot.tolist() == [False, True, False, True, True, False, True, False, False, True, True]
    assert opener.tolist() == [True] + [False] * 4 + [True] + [False] * 5
