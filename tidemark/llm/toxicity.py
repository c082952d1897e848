"""Severity of toxic language by cumulative-link ordinal regression.

Features are whole words and word beginnings. Those that tell toxic from clean texts
are picked by their document counts in a sample of labelled rows of bounded size; the
model is fitted on the same sample. Grades are ordered: 0 clean, 1 toxic, 2 toxic with
at least the median density of telling words. One weight vector is shared by the two
thresholds: P(grade > k) = sigmoid(w x - t_k). The output is the expected grade.

Every text is scored whole. Defined cases: null or empty text scores as clean; without
labelled rows of both kinds nothing is toxic and severity is 0; repeated rows are
scored each; a document with several labels is toxic if one says so; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.session import cut_lineage

#: Labelled rows of each kind that are learned from, at most about.
ROWS_PER_KIND = 6000
#: Features that the model may have, and the fewest toxic rows one must occur in.
MOST_FEATURES = 2000
LEAST_ROWS = 4
BEGINNINGS = (4, 5, 6, 7)
MEMO_WORDS = 400_000
#: A document is rejected from this expected grade on.
REJECT = 0.5
LETTERS = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """The word itself, and its beginnings marked by a star."""
    return [word, *[f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n]]


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = set(LETTERS.findall((text or "").lower()))
            counts[toxic].update({f for w in words for f in features_of(w)})
    names = list(counts[1])  # a feature of no toxic row can't be picked
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.string()),
            pa.array([counts[1][f] for f in names], pa.int64()),
            pa.array([0] * len(names), pa.int64()),
        ],
        names=["feature", "toxic", "clean"],
    )
    names = [f for f, n in counts[0].items()]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.string()),
            pa.array([0] * len(names), pa.int64()),
            pa.array([counts[0][f] for f in names], pa.int64()),
        ],
        names=["feature", "toxic", "clean"],
    )


@dataclass
class Model:
    vocabulary: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def features(self, text: str, memo: dict[str, tuple[int, ...]]) -> Counter:
        hits: Counter = Counter()
        for word in LETTERS.findall(text.lower()):
            got = memo.get(word)
            if got is None:
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                look = self.vocabulary
                got = memo[word] = tuple(look[f] for f in features_of(word) if f in look)
            if got:
                hits.update(got)
        return hits

    def severity(self, hits: Counter) -> float:
        """Expected grade: the sum over thresholds of the chance to be above them."""
        z = sum(self.weights[i] * np.log1p(n) for i, n in hits.items())
        return float(_sigmoid(z - self.thresholds).sum())


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Sparse:
    """A matrix of which only the entries that are not zero are held."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.shape[0])

    def transposed_times(self, e: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * e[self.row], self.shape[1])


def ordinal_fit(
    x: Sparse, grades: np.ndarray, levels: int, *, l2: float = 1e-3, steps: int = 300
) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and increasing thresholds, by accelerated gradient steps on the
    mean log loss of the cumulative logits. Grades weigh alike, whatever their counts."""
    above = (grades[:, None] > np.arange(levels - 1)).astype(float)
    share = np.array([max(1, (grades == g).sum()) for g in range(levels)])
    weight = (len(grades) / levels / share)[grades][:, None]
    w, first, gaps = np.zeros(x.shape[1]), 0.0, np.zeros(levels - 2)
    state = [np.zeros_like(w), 0.0, np.zeros_like(gaps)]
    second = [np.zeros_like(w), 0.0, np.zeros_like(gaps)]
    for step in range(1, steps + 1):
        t = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        error = (_sigmoid(x.times(w)[:, None] - t) - above) * weight / len(grades)
        by_threshold = -error.sum(0)
        later = np.array([by_threshold[k + 1 :].sum() for k in range(levels - 2)])
        slopes = [x.transposed_times(error.sum(1)) + l2 * w, by_threshold.sum(), later * np.exp(gaps)]
        moves = []
        for i, g in enumerate(slopes):
            state[i] = 0.9 * state[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            moves.append(
                0.1 * (state[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-9)
            )
        w, first, gaps = w - moves[0], first - moves[1], gaps - moves[2]
    return w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_KIND) -> Model | None:
    """A model from ``documents`` and ``labels``; None without rows of both kinds."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r[0]: r[1] for r in marked.groupBy("toxic").count().collect()}
    if set(sizes) != {0, 1}:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 30))
    limit = F.when(F.col("toxic") == 1, int(min(1.0, rows / sizes[1]) * (1 << 30))).otherwise(
        int(min(1.0, rows / sizes[0]) * (1 << 30))
    )
    picked = marked.where(draw < limit)  # about 2 * rows rows at most, so small by design
    sample = cut_lineage(
        docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("toxic", "text")
    )
    counted = sample.mapInArrow(_document_counts, "feature string, toxic long, clean long")
    kinds = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if set(kinds) != {0, 1}:
        return None
    rate = (F.col("toxic") + 0.5) / (kinds[1] + 1.0)
    other = (F.col("clean") + 0.5) / (kinds[0] + 1.0)
    telling = (
        counted.groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= LEAST_ROWS) & (rate > 4 * other))
        .withColumn("gain", (rate - other) * F.log(rate / other))
        .orderBy(F.col("gain").desc(), "feature")
        .limit(MOST_FEATURES)
        .collect()
    )
    if not telling:
        return None
    model = Model({r.feature: i for i, r in enumerate(telling)}, np.zeros(len(telling)), np.zeros(2))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            got = [model.features(t or "", memo) for t in batch.column(1).to_pylist()]
            size = [len(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([np.array(list(h), np.int32).tobytes() for h in got], pa.binary()),
                    pa.array([np.array(list(h.values()), np.int32).tobytes() for h in got], pa.binary()),
                    pa.array(size, pa.int64()),
                ],
                names=["toxic", "slots", "counts", "size"],
            )

    rows_ = sample.mapInArrow(hits, "toxic int, slots binary, counts binary, size long").toPandas()
    rows_ = rows_.sort_values(["toxic", "size", "slots", "counts"], ignore_index=True)
    slots = np.frombuffer(b"".join(rows_["slots"]), np.int32)
    counts = np.frombuffer(b"".join(rows_["counts"]), np.int32)
    number = np.repeat(np.arange(len(rows_), dtype=np.int32), rows_["slots"].map(len) // 4)
    x = Sparse(number, slots, np.log1p(counts), (len(rows_), len(telling)))
    toxic = rows_["toxic"].to_numpy() == 1
    density = x.times(np.ones(len(telling))) / np.log(np.e + rows_["size"].to_numpy())
    grades = toxic.astype(int)
    grades[toxic & (density >= np.median(density[toxic]))] = 2
    model.weights, model.thresholds = ordinal_fit(x, grades, 3)
    return model


def severities(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_KIND) -> DataFrame:
    """``doc_id, severity, grade, toxic``, a row per document."""
    model = fit(docs, labels, rows)
    if model is None:
        return docs.select(
            "doc_id", F.lit(0.0).alias("severity"), F.lit(0).alias("grade"), F.lit(False).alias("toxic")
        )
    return docs.select("doc_id", "text").mapInArrow(
        _score(model, keep=False), "doc_id long, severity double, grade int, toxic boolean"
    )


def _score(model: Model, keep: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            value = np.array([model.severity(model.features(t or "", memo)) for t in texts])
            if keep:
                yield batch.filter(pa.array(value < REJECT))
                continue
            grade = np.minimum(2, np.floor(value + 0.5)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(value), pa.array(grade), pa.array(value >= REJECT)],
                names=["doc_id", "severity", "grade", "toxic"],
            )

    return score


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_KIND) -> DataFrame:
    """The documents below the rejecting severity, with all their columns."""
    model = fit(docs, labels, rows)
    return docs if model is None else docs.mapInArrow(_score(model, keep=True), docs.schema)


@query()
def op6_toxicity(spark, folder):
    return severities(table(spark, folder, "documents"), table(spark, folder, "labels"))
