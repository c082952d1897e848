"""Language of a text: sparse multinomial logistic regression on TF-IDF of character
n-grams, trained by follow-the-regularised-leader with elastic-net penalties, then
calibrated by a temperature.

Document frequencies are counted over all training rows. The model is fitted on a
sample of training rows of bounded size, balanced over the languages; its size does not
depend on the table's. Every text is then scored whole.

Defined cases: null text, or text without a letter, is ``und`` with score 0; so is every
text where no row is labelled; a row without label takes no part in training; repeated
rows count each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table

BUCKETS = 1 << 12
ORDERS = (1, 2, 3)
WIDTH = BUCKETS * len(ORDERS)
#: Rows that the model is fitted on, at most about.
TRAINING_ROWS = 2400
#: A language's share of them when there are many.
LEAST_PER_LANGUAGE = 20
UNKNOWN = "und"
MIX = np.uint64(0x9E3779B97F4A7C15)


def ngram_counts(text: str) -> np.ndarray:
    """Hashed counts of the 1-, 2- and 3-grams of the lower-cased text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.zeros(WIDTH, np.float32)
    grams = codes.astype(np.uint64)
    for i, n in enumerate(ORDERS):
        if len(codes) < n:
            break
        if n > 1:
            grams = grams[:-1] * np.uint64(1_000_003) + codes[n - 1 :]
        slots = ((grams * MIX) >> np.uint64(52)).astype(np.int64)
        counts[i * BUCKETS : (i + 1) * BUCKETS] = np.bincount(slots, minlength=BUCKETS)
    return counts


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of unit length: dampened counts times inverse document frequency."""
    x = np.log1p(counts) * idf
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.maximum(norm, 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        return weigh(counts, self.idf) @ self.weights + self.bias


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(
    x: np.ndarray, y: np.ndarray, classes: int, rows: np.ndarray, *, epochs: int = 4, batch: int = 8,
    alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from the given ``rows``. Coordinates whose leader stays within ``l1`` are zero."""
    width = x.shape[1] + 1
    z, n = np.zeros((width, classes)), np.zeros((width, classes))
    penalty = np.full((width, 1), l1)
    penalty[-1] = 0.0

    def leader() -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - penalty, 0.0)
        return -shrunk / ((beta + np.sqrt(n)) / alpha + l2)

    draw = np.random.default_rng(3)
    w = leader()
    for _ in range(epochs):
        order = draw.permutation(rows)
        for i in range(0, len(order), batch):
            at = order[i : i + batch]
            part = np.concatenate([x[at], np.ones((len(at), 1), x.dtype)], 1)
            error = _softmax(part @ w)
            error[np.arange(len(at)), y[at]] -= 1.0
            g = part.T @ error / len(at)
            sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / alpha
            z += g - sigma * w
            n += g * g
            w = leader()
    return w[:-1].astype(np.float32), w[-1].astype(np.float32)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on held-back rows, by golden section."""

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))
        return -float(np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean())

    low, high, ratio = -4.0, 2.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(WIDTH, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen += ngram_counts(text) > 0
    slots = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(slots.astype(np.int32)), pa.array(seen[slots])], names=["slot", "n"]
    )


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [ngram_counts(t) for t in batch.column(1).to_pylist()]
        slots = [np.flatnonzero(r).astype(np.int32) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([s.tobytes() for s in slots], pa.binary()),
                pa.array([r[s].tobytes() for r, s in zip(rows, slots)], pa.binary()),
            ],
            names=["lang", "slots", "counts"],
        )


def fit(labelled: DataFrame, rows: int = TRAINING_ROWS) -> Model | None:
    """A model from ``doc_id, text, lang`` rows; None where there is none to learn from."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    share = max(LEAST_PER_LANGUAGE, rows // len(languages))
    counted = usable.select("text").mapInArrow(_frequencies, "slot int, n long")
    idf = np.zeros(WIDTH, np.float32)
    total = sum(sizes.values())
    for slot, n in counted.groupBy("slot").agg(F.sum("n")).collect():
        idf[slot] = np.log((1 + total) / (1 + n)) + 1.0

    draw = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30))
    limits = F.create_map(
        *[F.lit(v) for lang in languages for v in (lang, int(min(1.0, share / sizes[lang]) * (1 << 30)))]
    )
    sample = usable.where(draw < F.element_at(limits, F.col("lang"))).select("lang", "text")
    got = sample.mapInArrow(_features, "lang string, slots binary, counts binary").toPandas()
    got = got.sort_values(["lang", "slots", "counts"], ignore_index=True)
    number = {lang: i for i, lang in enumerate(languages)}
    y = got["lang"].map(number).to_numpy()
    x = np.zeros((len(got), WIDTH), np.float32)
    for row, slots, counts in zip(x, got["slots"], got["counts"]):
        at = np.frombuffer(slots, np.int32)
        row[at] = weigh(np.frombuffer(counts, np.float32), idf[at])
    if not len(y):
        return None
    del got
    held = np.random.default_rng(7).random(len(y)) < 0.1
    if held.sum() < 2 or (~held).sum() < 2:
        held[:] = False
    weights, bias = ftrl(x, y, len(languages), np.flatnonzero(~held))
    model = Model(languages, idf, weights, bias)
    if held.any():
        model.temperature = temperature(x[held] @ weights + bias, y[held])
    return model


def _predict(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages, dtype=object)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            labels: list[str] = []
            scores: list[float] = []
            for i in range(0, len(texts), 128):
                part = texts[i : i + 128]
                counts = np.stack([ngram_counts(t or "") for t in part])
                p = _softmax(model.logits(counts) / model.temperature)
                best = p.argmax(1)
                labels += names[best].tolist()
                scores += p[np.arange(len(part)), best].astype(float).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return predict


def languages(docs: DataFrame, held_out: Column, rows: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; rows with ``held_out`` are not learned from."""
    out = held_out.alias("held_out")
    readable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    model = fit(docs.where(~held_out).select("doc_id", "text", "lang"), rows)
    nothing = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")]
    if model is None:
        return docs.select("doc_id", out, *nothing)
    scored = docs.where(readable).select("doc_id", out, "text").mapInArrow(
        _predict(model), "doc_id long, held_out boolean, lang_pred string, score double"
    )
    return scored.unionByName(docs.where(~readable).select("doc_id", out, *nothing))


@query()
def op1_language(spark, folder):
    docs = table(spark, folder, "documents")
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return languages(docs, F.crc32(text_id.cast("binary")) % 5 == 0)
