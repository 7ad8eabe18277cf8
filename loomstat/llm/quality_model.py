"""Quality classifier: logistic regression on hashed word n-grams, learnt by FTRL-proximal updates.

Tokens are runs of letters and digits, and runs of other symbols, in their own case; one-
and two-token n-grams are hashed to ``2**BITS`` features, each counted once and scaled to
length one.  Scores are sparse dot products.

Training takes a sample whose bound is a parameter: at most ``per_class`` labelled
documents of each class, those of smallest hash; the offset is then moved to the class
shares of all labelled rows.  Features of the sample, not texts, reach the driver.

NULL and empty texts have no features and get the offset's score.  A document labelled
both ways counts as 0; NULL labels are left out; without any label of a class the score
is 0.5.  Repeated rows get equal scores; NULL ids stay; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.llm import tokens
from loomstat.llm.blocks import give_back, rows_of
from loomstat.llm.windows import mixed, odd

BITS, PER_CLASS, PASSES = 18, 2000, 5
ALPHA, BETA, L1, L2 = 3.0, 1.0, 0.01, 0.01
CHUNK = 500_000


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, where each text's begin and end): distinct hashed one- and two-token n-grams."""
    buf, starts = tokens.joined(texts)
    begin, one = tokens.mixed_tokens(buf)
    text = np.searchsorted(starts, begin, side="right") - 1
    near = text[1:] == text[:-1]
    two = mixed(one[:-1] * odd(61) + one[1:])[near]
    wide = np.uint64(64 - BITS)
    code = np.concatenate([text, text[:-1][near]]).astype(np.int64) << BITS | (np.concatenate([one, two]) >> wide).astype(np.int64)
    code = np.unique(code)
    return code & ((1 << BITS) - 1), np.searchsorted(code >> BITS, np.arange(len(texts) + 1))


def train(rows: list[np.ndarray], labels: list[int], passes: int = PASSES, seed: int = 5) -> np.ndarray:
    """Weights (the offset last) after FTRL-proximal steps over the rows in a fixed random order."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    l1 = np.full(len(z), L1)
    l1[-1] = 0.0

    def weights(at):
        push = np.sign(z[at]) * l1[at] - z[at]
        return np.where(np.abs(z[at]) <= l1[at], 0.0, push / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            at = np.append(rows[i], 1 << BITS)
            x = np.full(len(at), 1 / np.sqrt(max(len(rows[i]), 1)))
            x[-1] = 1.0
            w = weights(at)
            g = (_sigmoid(float(w @ x)) - labels[i]) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return weights(np.arange(len(z)))


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -35, 35)))


def _texts(batches):
    for batch in batches:
        at, size, held = 0, 0, []
        for i, (_, t) in enumerate(rows_of(batch)):
            held.append((t or "").encode())
            size += len(held[-1])
            if size >= CHUNK:
                yield batch.slice(at, len(held)), held
                at, size, held = i + 1, 0, []
        if held:
            yield batch.slice(at, len(held)), held
    give_back()


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col="doc_id", text_col="text", label_col="quality", per_class=PER_CLASS) -> np.ndarray | None:
    """Weights learnt from the rows of ``labels`` for which ``learn`` holds."""
    marked = labels.where(learn & labels[label_col].isin(0, 1) & labels[id_col].isNotNull())
    marked = marked.groupBy(labels[id_col].alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    order = [F.xxhash64("id"), F.col("id")]
    chosen = [marked.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])  # 2 * per_class rows at most: small enough to broadcast
    named = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).join(F.broadcast(sample), "id")

    def run(batches):
        for batch, texts in _texts(batches):
            found, ends = features(texts)
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], ["id", "label", "f"])

    got = named.select("id", "text", "label").mapInArrow(run, "id long, label int, f array<int>").toArrow()
    order = np.argsort(got.column("id").to_numpy(), kind="stable")
    lists = got.column("f").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    label = got.column("label").to_numpy()
    rows = [lists[int(i)].values.to_numpy() for i in order]
    taken = np.bincount(label, minlength=2)
    if not taken.all():
        return None
    weights = train(rows, label[order].tolist())
    weights[-1] += np.log(counts[1] / counts[0]) - np.log(taken[1] / taken[0])
    return weights.astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray | None, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: ``doc_id`` and ``score``, the chance of label 1."""

    def run(batches):
        for batch, texts in _texts(batches):
            if weights is None:
                value = np.full(len(texts), 0.5)
            else:
                found, ends = features(texts)
                total = np.concatenate([[0.0], np.cumsum(weights[found], dtype=np.float64)])
                value = _sigmoid((total[ends[1:]] - total[ends[:-1]]) / np.sqrt(np.maximum(np.diff(ends), 1)) + float(weights[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], ["doc_id", "score"])

    named = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return named.mapInArrow(run, "doc_id long, score double")
