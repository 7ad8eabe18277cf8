"""Language identification by a small convolutional network over bytes.

Texts are cut into windows of ``WINDOW`` bytes (the last one padded with zeros).  Each
byte has an embedding; filters of several widths slide over a window, are max-pooled,
and a softmax names the language.  A text gets the mean of its windows' probabilities.
All windows of a text are scored.

The network is trained in numpy on a sample whose bound is a parameter: at most
``per_class`` documents of each language, those of smallest hash, and ``per_doc``
windows of each.  The weights are a few thousand numbers.

NULL texts, and texts without a letter, are ``und`` with score 0, as is everything when
no labelled row is there.  Repeated rows get equal answers; NULL ids stay; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomstat.llm.blocks import give_back, rows_of

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
PER_CLASS, PER_DOC, EPOCHS, BATCH, RATE = 300, 4, 8, 64, 0.01
_LETTER = re.compile(r"[^\W\d_]")
_LANES = max(WIDTHS)


def to_windows(text: bytes) -> np.ndarray:
    """All windows of a text, one at least."""
    n = max(1, -(-len(text) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, WINDOW)


def _neighbours(params: dict, x: np.ndarray) -> np.ndarray:
    """The embeddings of each byte and the following ones, side by side."""
    e = params["embed"][x]
    n = WINDOW - _LANES + 1
    return np.concatenate([e[:, j : j + n] for j in range(_LANES)], axis=2)


def _mask() -> np.ndarray:
    """Which lanes a filter of each width reads."""
    rows = np.repeat(np.arange(_LANES), EMBED)[:, None]
    return (rows < np.repeat(WIDTHS, FILTERS)[None, :]).astype(np.float32)


def _forward(params: dict, x: np.ndarray):
    near = _neighbours(params, x)
    conv = (near.reshape(-1, near.shape[2]) @ params["conv"]).reshape(near.shape[0], near.shape[1], -1)
    best = conv.argmax(axis=1)
    pooled = np.take_along_axis(conv, best[:, None], axis=1)[:, 0] + params["bias"]
    hidden = np.maximum(pooled, 0)
    logits = hidden @ params["dense"] + params["out"]
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return near, best, pooled, hidden, p / p.sum(axis=1, keepdims=True)


def probabilities(params: dict, x: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Class probabilities of windows, some at a time."""
    out = [np.zeros((0, len(params["out"])), np.float32)]
    for at in range(0, len(x), chunk):
        near = _neighbours(params, x[at : at + chunk])
        pooled = (near.reshape(-1, near.shape[2]) @ params["conv"]).reshape(near.shape[0], near.shape[1], -1).max(axis=1) + params["bias"]
        logits = np.maximum(pooled, 0) @ params["dense"] + params["out"]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        out.append(p / p.sum(axis=1, keepdims=True))
    return np.concatenate(out)


def train(x: np.ndarray, y: np.ndarray, classes: int, seed: int = 7) -> dict:
    """Fit the network to windows ``x`` and class numbers ``y`` by Adam on cross-entropy."""
    rng = np.random.default_rng(seed)
    lanes, total, mask = _LANES * EMBED, FILTERS * len(WIDTHS), _mask()
    params = {
        "embed": rng.normal(0, 1, (256, EMBED)),
        "conv": rng.normal(0, (1 / lanes) ** 0.5, (lanes, total)) * mask,
        "bias": np.zeros(total),
        "dense": rng.normal(0, (1 / total) ** 0.5, (total, classes)),
        "out": np.zeros(classes),
    }
    params = {k: v.astype(np.float32) for k, v in params.items()}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    weight = (len(y) / (classes * np.maximum(np.bincount(y, minlength=classes), 1)))[y].astype(np.float32)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            near, best, pooled, hidden, p = _forward(params, x[rows])
            wrong = p.copy()
            wrong[np.arange(len(rows)), y[rows]] -= 1
            wrong *= weight[rows, None] / len(rows)
            back = (wrong @ params["dense"].T) * (pooled > 0)
            grad = {"dense": hidden.T @ wrong, "out": wrong.sum(0), "bias": back.sum(0)}
            read = np.take_along_axis(near, best[:, :, None], axis=1)  # the bytes each filter's best place read
            grad["conv"] = np.einsum("bfl,bf->lf", read, back) * mask
            lane = (back[:, :, None] * params["conv"].T[None]).reshape(-1, _LANES, EMBED)
            spot = (best[:, :, None] + np.arange(_LANES)).reshape(-1, _LANES)
            letters = x[rows][np.repeat(np.arange(len(rows)), total)[:, None], spot]
            grad["embed"] = np.zeros_like(params["embed"])
            np.add.at(grad["embed"], letters.ravel(), lane.reshape(-1, EMBED))
            step += 1
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                params[k] -= (RATE * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return params


def _chosen(labelled: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each label, those of smallest hash."""
    order = F.xxhash64("id", "text")
    place = Window.partitionBy("label").orderBy(order, "id")
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}  # a row per language
    # a first cut by hash, so that few rows are ranked; it leaves four times the rows wanted
    share = F.lit(1.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, 4 * max(per_class, 50) / n))).otherwise(share)
    near = labelled.where(F.pmod(order, F.lit(1 << 20)) < share * F.lit(float(1 << 20)))
    return near.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= per_class).drop("_place")


def fit(docs: DataFrame, labelled: Column, id_col="doc_id", text_col="text", label_col="lang", per_class=PER_CLASS, per_doc=PER_DOC) -> tuple[list, dict | None]:
    """(languages, network) learnt from the rows for which ``labelled`` holds."""

    def cut(batches):
        for batch in batches:
            labels, windows = [], []
            for label, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                all_windows = to_windows(text.encode())
                some = np.unique(np.linspace(0, len(all_windows) - 1, per_doc).astype(int))
                windows += [w.tobytes() for w in all_windows[some]]
                labels += [label] * len(some)
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(windows, pa.binary())], ["label", "window"])

    rows = docs.where(labelled & docs[label_col].isNotNull() & docs[text_col].isNotNull())
    named = rows.select(docs[id_col].alias("id"), docs[label_col].cast("string").alias("label"), docs[text_col].cast("string").alias("text"))
    sample = _chosen(named, per_class).mapInArrow(cut, "label string, window binary")
    table = sorted((r["label"], bytes(r["window"])) for r in sample.collect())
    languages = sorted({label for label, _ in table})
    if not languages:
        return [], None
    x = np.frombuffer(b"".join(w for _, w in table), np.uint8).reshape(-1, WINDOW)
    y = np.array([languages.index(label) for label, _ in table])
    return languages, train(x, y, len(languages))


def _then_none(rows):
    """(number, second value) of each row, and a last (None, None)."""
    for i, (_, value) in enumerate(rows):
        yield i, value
    yield None, None


def predict(docs: DataFrame, model: tuple[list, dict | None], id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: ``doc_id``, ``lang_pred`` and ``score`` (mean probability of the language)."""
    languages, params = model

    def run(batches):
        for batch in batches:
            names, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            held, parts, size = [], [], 0
            for i, text in _then_none(rows_of(batch)):
                if held and (i is None or size >= 1_000_000):
                    p = probabilities(params, np.concatenate(parts))
                    starts = np.cumsum([0, *map(len, parts)])[:-1]
                    mean = np.add.reduceat(p.astype(np.float64), starts, axis=0) / np.array(list(map(len, parts)))[:, None]
                    for j, m in zip(held, mean, strict=True):
                        names[j], scores[j] = languages[int(m.argmax())], min(1.0, float(m.max()))
                    held, parts, size = [], [], 0
                if i is not None and text and params is not None and _LETTER.search(text):
                    held.append(i)
                    parts.append(to_windows(text.encode()))
                    size += len(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(scores)], ["doc_id", "lang_pred", "score"])
        give_back()

    named = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return named.mapInArrow(run, "doc_id long, lang_pred string, score double")
