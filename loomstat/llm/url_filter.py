"""URL filters: rules on host and path first, then logistic regression on hashed character n-grams.

A URL's host is what follows its first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z
in lower case; its path goes on from there up to ``?``, ``#`` or the end.  NULL, empty and
other URLs without ``://`` have an empty host and path.

A rule (host, path, verdict) fits its host and all hosts below it where the path starts
with the rule's; the one with the longest host and path together wins, then the one with
the longest host.  Rules said twice with different verdicts allow; rules without a host or
verdict are left out.  Up to ``RULES_IN_TASK`` rules are looked up inside the tasks that
score, without a shuffle; more are joined by host suffix and path prefix (``fitting``).

URLs without a rule get the model's verdict: features are the 3 to 5 byte n-grams of host
and path, hashed to ``2**BITS`` weights, host and path apart.  ``fit`` learns from a table
(url, label), 1 for URLs to block: at most ``per_class`` rows of each class, those of
smallest hash.  A URL is blocked from a score of ``BLOCK_FROM``: a page blocked in error is
lost for good.  Without both classes there is no model and what no rule names is allowed.

Every row is judged by itself, so hot hosts, repeated rows, NULL ids and very long URLs
need nothing special; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm.windows import mixed

BITS, GRAMS, PER_CLASS = 17, (3, 4, 5), 5000
STEPS, RATE, L2, BLOCK_FROM = 300, 0.5, 5e-5, 0.75
MADE_WORDS = 600
RULES_IN_TASK = 50_000
CHUNK = 1_000_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OUT = "host string, path string, rule string, verdict string, score double"

#: What the small labelled table is made of: words of URLs to block and of ordinary ones.
BLOCKED_WORDS = """casino bets betting poker slots jackpot roulette lottery gamble wager blackjack porn xxx sex adult nude escort camgirl
erotic viagra cialis pills steroids replica payday quickloan crack keygen warez torrent nulled cheats phish malware spyware ads adserver
adclick track tracker tracking popup banner clickbait affiliate spam scam giveaway prize winner win free bonus cheap""".split()
ORDINARY_WORDS = """news blog docs wiki school museum library weather travel recipes garden science health history music books city
university research forum support shop sports team cooking river mountain market letter paper voice forest winter doctor bridge
village kitchen theatre railway harbour island poetry painting physics biology chemistry language grammar student teacher
company office project software guide manual archive journal review story people family house country world about contact""".split()
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve lo ma ne pa ri so ta mi ko la".split()
TEMPLATES = [
    "https://{a}-{b}.example.com/en/{n}",
    "http://www.{a}{b}.example.net/de/{n}.html",
    "https://m.{b}-{a}.example.org/fr/{n}/",
    "https://blog.{a}.com/{b}/{n}?page=2",
    "http://{b}.{a}.net/",
    "https://{b}.org/{a}/{b}-{n}.html",
    "https://www.{b}.example.com/{b}/{a}-{n}",
]


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): every listed word in every template, beside ordinary words and made-up ones, 1 = to block."""
    rng = np.random.default_rng(11)

    def plain():
        return str(rng.choice(ORDINARY_WORDS)) if rng.random() < 0.3 else "".join(rng.choice(SYLLABLES, rng.integers(2, 5)))

    made = ["".join(rng.choice(SYLLABLES, rng.integers(2, 6))) for _ in range(MADE_WORDS)]
    words = [(w, 1) for w in BLOCKED_WORDS * 3] + [(w, 0) for w in ORDINARY_WORDS + made]
    rows = [(t.format(a=w, b=plain(), n=int(rng.integers(1, 9999))), y) for w, y in words for t in TEMPLATES]
    return spark.createDataFrame(rows, "url string, label int")


def host_and_path(url: Column) -> list[Column]:
    """The host and the path of a URL, empty where it has none."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    part = [F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i) for i in (1, 2)]
    return [F.translate(part[0], UPPER, UPPER.lower()).alias("host"), part[1].alias("path")]


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, number of the row of each): hashed n-grams, with marks at both ends of host and path."""
    pieces = [b"\x01" + s.encode() + b"\x02" for pair in zip(hosts, paths) for s in pair]
    buf = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint64)
    piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    codes, rows = [], []
    for n in GRAMS:
        at = np.flatnonzero(piece[: len(buf) - n + 1] == piece[n - 1 :]) if len(buf) >= n else np.zeros(0, np.int64)
        word = np.uint64(n) << np.uint64(48) | (piece[at] % 2).astype(np.uint64) << np.uint64(56)
        for k in range(n):
            word |= buf[at + k] << np.uint64(8 * k)
        codes.append((mixed(word) >> np.uint64(64 - BITS)).astype(np.int64))
        rows.append(piece[at] // 2)
    return np.concatenate(codes), np.concatenate(rows)


def train(code: np.ndarray, row: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights (the offset last) of the penalised logistic loss, by adaptive gradient steps over all rows."""
    weights, seen = np.zeros((1 << BITS) + 1), np.full((1 << BITS) + 1, 1e-8)
    share = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())  # both classes count the same
    for _ in range(STEPS):
        slope = (_sigmoid(np.bincount(row, weights[code], len(label)) + weights[-1]) - label) * share
        push = np.append(np.bincount(code, slope[row], 1 << BITS) + L2 * weights[:-1], slope.sum())
        seen += push * push
        weights -= RATE * push / np.sqrt(seen)
    return weights


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -35, 35)))


def fit(labelled: DataFrame, per_class: int = PER_CLASS, url_col="url", label_col="label") -> np.ndarray | None:
    """Weights learnt from a bounded sample of a labelled table; None if a class has no rows."""
    known = labelled.where(labelled[label_col].isin(0, 1)).select(*host_and_path(labelled[url_col]), labelled[label_col].cast("int").alias("y")).distinct()
    order = [F.xxhash64("host", "path"), F.col("host"), F.col("path")]
    sample = known.where("y = 1").orderBy(*order).limit(per_class).unionByName(known.where("y = 0").orderBy(*order).limit(per_class))
    rows = sorted(sample.collect())  # 2 * per_class URLs at most
    label = np.array([r.y for r in rows])
    if len(set(label.tolist())) < 2:
        return None
    return train(*features([r.host for r in rows], [r.path for r in rows]), label).astype(np.float32)


def standard_rules(rules: DataFrame) -> DataFrame:
    """(rule_host, rule_path, said): one row per rule, hosts in lower case."""
    host, path = F.translate(rules["host"], UPPER, UPPER.lower()), F.coalesce(rules["path"], F.lit(""))
    told = rules.where((F.length(rules["host"]) > 0) & rules["verdict"].isNotNull())
    return told.groupBy(host.alias("rule_host"), path.alias("rule_path")).agg(F.min("verdict").alias("said"))


def suffixes(host: str) -> list[str]:
    """The host and all hosts above it."""
    labels = host.split(".")
    return [".".join(labels[i:]) for i in range(len(labels))]


def _finder(rules: list):
    """A function (host, path) -> (rule, verdict) over rules held in memory."""
    said = {(r.rule_host, r.rule_path): r.said for r in rules}
    widths: dict[str, list[int]] = {}
    for host, path in said:
        widths[host] = sorted({len(path), *widths.get(host, [])}, reverse=True)

    def find(host, path):
        best = None
        for suffix in suffixes(host):
            fit = next((n for n in widths.get(suffix, ()) if (suffix, path[:n]) in said and n <= len(path)), None)
            if fit is not None and (best is None or len(suffix) + fit > best[0]):
                best = (len(suffix) + fit, suffix, path[:fit])
        return (None, None) if best is None else (best[1] + best[2], said[best[1:]])

    return find


def fitting(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct (host, path) that some rule fits, by joins on suffix and prefix.

    A host suffix is joined with the lengths its rules' paths have, then every prefix of
    such a length with the rule itself, so no host meets rules that do not fit it.
    """
    widths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("widths"))
    labels = F.split("host", r"\.")
    above = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    each = urls.select("host", "path").distinct().withColumn("rule_host", F.explode(above))
    sized = each.join(widths, "rule_host").withColumn("n", F.explode("widths")).where(F.col("n") <= F.length("path"))
    found = sized.withColumn("rule_path", F.expr("substring(path, 1, n)")).join(rules, ["rule_host", "rule_path"])
    best = F.max(F.struct(F.length("rule_host") + F.col("n"), F.length("rule_host").alias("h"), F.concat("rule_host", "rule_path").alias("rule"), "said"))
    return found.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.rule", F.col("b.said").alias("verdict"))


def _chunks(batches):
    for batch in batches:
        hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
        size = np.cumsum([len(h) + len(p) for h, p in zip(hosts, paths)]) // CHUNK
        ends = [*(np.flatnonzero(np.diff(size)) + 1).tolist(), len(hosts)]
        for at, end in zip([0, *ends], ends):
            yield batch.slice(at, end - at), hosts[at:end], paths[at:end]


def judge(pages: DataFrame, rules: DataFrame, weights: np.ndarray | None, id_col="page_id", url_col="url", rules_in_task: int = RULES_IN_TASK) -> DataFrame:
    """Per row: ``page_id``, ``host``, ``path``, ``rule`` (NULL if none fits), ``verdict`` and ``score``, the model's chance of block."""
    rules = standard_rules(rules)
    held = rules.limit(rules_in_task + 1).collect()
    named = pages.select(pages[id_col].cast("bigint").alias("page_id"), *host_and_path(pages[url_col]))
    if len(held) <= rules_in_task:
        find = _finder(held)
    else:
        find = None
        named = named.join(fitting(named, rules), ["host", "path"], "left").select("page_id", "host", "path", "rule", "verdict")

    def run(batches):
        for batch, hosts, paths in _chunks(b for b in batches if b.num_rows):
            if weights is None:
                score = np.zeros(len(hosts))
            else:
                code, row = features(hosts, paths)
                score = _sigmoid(np.bincount(row, weights[code].astype(np.float64), len(hosts)) + float(weights[-1]))
            if find is None:
                rule, said = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
            else:
                rule, said = zip(*map(find, hosts, paths))
            verdict = [v if r is not None else "block" if s >= BLOCK_FROM else "allow" for r, v, s in zip(rule, said, score)]
            columns = [*batch.columns[:3], pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict", "score"])

    return named.mapInArrow(run, f"page_id long, {OUT}")
