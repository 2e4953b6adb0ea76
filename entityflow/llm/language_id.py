"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

The weights are trained by follow-the-regularised-leader steps with an elastic-net penalty, so they are sparse; the
temperature of the probabilities is then fitted on training rows that the steps haven't seen. Document frequencies cover
all training rows, the steps a bounded sample of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.llm.common import id_and_text, id_type, per_process, steps, unit_hash
from entityflow.llm.token_counts import LETTER, character_classes
from entityflow.session import settle

SIZES = (1, 2, 3)  # characters of an n-gram
BUCKETS = 1 << 15
PIECE = 1 << 20  # characters that are hashed at once
SAMPLE_ROWS = 4000  # rows that the weights are trained on, about, shared evenly by the languages
LEAST_PER_LANGUAGE = 20
EPOCHS = 3
# Step size and its offset, and the penalties on the sum of weights and of their squares.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.5
UNKNOWN = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_counts(text: str) -> np.ndarray | None:
    """How often each bucket's n-grams occur; None without a letter. Other signs than letters count as one space each."""
    table = per_process("character classes", character_classes)
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letters = table[codes] == LETTER
    if not letters.any():
        return None
    codes = np.concatenate([[32], np.where(letters, codes, np.uint32(32)), [32]]).astype(np.uint64)
    counts = np.zeros(BUCKETS, np.int64)
    for a in range(0, len(codes), PIECE):
        for size in SIZES:
            part = codes[a:a + PIECE + size - 1]
            n = len(part) - size + 1
            if n <= 0:
                continue
            gram = np.full(n, size, np.uint64)
            for i in range(size):
                gram = gram << np.uint64(21) | part[i:n + i]
            counts += np.bincount((gram * MIX >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    return counts


def weigh(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Used buckets and their TF-IDF values: (1 + log count) * idf, scaled to length one."""
    at = np.flatnonzero(counts)
    x = (1 + np.log(counts[at])) * idf[at]
    return at, x / np.sqrt((x * x).sum())


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # BUCKETS + 1 rows, the last for the bias
    temperature: float

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text) if text and self.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*weigh(counts, self.idf)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader over sparse rows: per weight, a sum of gradients and a sum of their squares."""

    def __init__(self, classes: int):
        self.z, self.n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def step(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, BUCKETS), np.append(x, 1.0)
        w = self.weights(at)
        miss = softmax(x @ w)
        miss[label] -= 1
        g = x[:, None] * miss
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm.

    One row's worth of doubt is spread over all classes, so that rows without an error don't ask for certainty.
    """
    doubt = 1 / (len(labels) + 1)

    def loss(t):
        p = np.log(np.maximum(softmax(logits / np.exp(t)), 1e-300))
        return -((1 - doubt) * p[np.arange(len(labels)), labels] + doubt * p.mean(1)).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, docs = np.zeros(BUCKETS, np.int64), 0
    for batch in steps(batches, 0):
        for text in batch.column(0).to_pylist():
            counts = gram_counts(text or "")
            if counts is not None:
                df += counts > 0
                docs += 1
    at = np.append(np.flatnonzero(df), BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(df[at[:-1]], docs))], ["bucket", "n"])


def _sample_rows(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 0):
            for text, lang, key in zip(*(c.to_pylist() for c in batch.columns)):
                counts = gram_counts(text or "")
                if counts is not None:
                    at, x = weigh(counts, idf)
                    yield pa.RecordBatch.from_pylist([{"key": key, "lang": lang, "buckets": at.astype(np.int32), "x": x.astype(np.float32)}],
                                                     pa.schema([("key", pa.int64()), ("lang", pa.string()), ("buckets", pa.list_(pa.int32())), ("x", pa.list_(pa.float32()))]))

    return run


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on (text, language) rows. Rows without a language or a letter teach nothing.

    ``sample_rows`` bounds the rows whose n-grams reach the driver, about: each language gives an even share of it, by
    hash of the text. A model without any language predicts ``und``.
    """
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")).where("lang is not null and text is not null")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().orderBy("lang").collect()}  # one row per class of the model
    df = np.zeros(BUCKETS + 1)
    for r in rows.select("text").mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        df[r.bucket] = r.n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    if not sizes:
        return Model([], idf, np.zeros((BUCKETS + 1, 0)), 1.0)
    languages = list(sizes)
    share = max(LEAST_PER_LANGUAGE, sample_rows // len(languages))
    rates = F.create_map(*[F.lit(x) for k in languages for x in (k, share / sizes[k])])
    sample = rows.select("text", "lang", F.xxhash64("text").alias("key")).where(unit_hash(F.col("text"), 17) < rates[F.col("lang")])
    seen = settle(sample.mapInArrow(_sample_rows(idf), "key long, lang string, buckets array<int>, x array<float>"), "language-sample").toArrow()
    label = np.array([languages.index(k) for k in seen["lang"].to_pylist()], np.int64)
    order = np.lexsort((label, seen["key"].to_numpy()))
    lists = [(np.asarray(a.values), np.asarray(x.values, np.float64)) for a, x in zip(seen["buckets"], seen["x"])]
    fifth = np.arange(len(order)) % 5 == 0
    held, fit = (order[fifth], order[~fifth]) if len(order) >= 50 else (order, order)
    leader, rng = Leader(len(languages)), np.random.default_rng(1)
    for _ in range(EPOCHS):
        for k in rng.permutation(fit):
            leader.step(*lists[k], int(label[k]))
    model = Model(languages, idf, leader.weights(slice(None)), 1.0)
    if len(held):
        model.temperature = fit_temperature(np.stack([model.logits(*lists[k]) for k in held]), label[held])
    return model


def _predictions(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([k for k, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())],
                                             ["id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row from its text alone; ``und`` with score 0 for null texts and texts without a letter."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_predictions(model), f"id {id_type(docs, id_col)}, lang_pred string, score double")
