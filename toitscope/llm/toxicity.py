"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature says whether an n-gram of the text's bytes (3 to 6, letters A-Z in lower case, blanks as spaces) occurs
in it. Its scale is the log of the ratio of its share among toxic training texts to that among others; n-grams too
rare or too even to matter are left out, and a logistic regression on the scaled features gives their weights.
Learning reads a bounded sample of labelled rows; counting runs in the tasks, and the driver receives the features
that are kept and which sample rows have them. Scoring reads every whole text, in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toitscope.llm import labelled
from toitscope.llm.shared import small_batches, staged, text_of

ORDERS = (3, 4, 5, 6)
SAMPLE_ROWS = 6000
FEATURES = 4096
LEAST_TEXTS = 4
LEAST_RATIO = 0.7
SMOOTH = 1.0
RIDGE = 1.0
ROUNDS = 400
THRESHOLD = 0.5
SLICE = 1 << 21
BITMAP_BITS = 20

_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[65:91] += 32
_LETTERS[9:14] = 32


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all texts in one array, each text between two spaces; starts and ends of the texts."""
    raw = [b" " + text.encode("utf-8", "surrogatepass") + b" " for text in texts]
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
    return _LETTERS[np.frombuffer(b"".join(raw), np.uint8)], np.concatenate([[0], ends[:-1]]), ends


def gram_hashes(letters: np.ndarray, order: int) -> np.ndarray:
    """A 32-bit hash of the n-gram at each position."""
    n = max(0, len(letters) - order + 1)
    h = np.full(n, order, np.uint32)
    for j in range(order):
        h *= np.uint32(0x01000193)
        h ^= letters[j : j + n]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    return h


@dataclass
class Model:
    """Hashes of the kept n-grams in ascending order, weight times scale of each, and the intercept."""

    grams: np.ndarray
    weights: np.ndarray
    bias: float

    def present(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, kept n-gram) pairs."""
        if not len(self.grams) or not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen = np.zeros(1 << BITMAP_BITS, bool)
        seen[self.grams >> np.uint32(32 - BITMAP_BITS)] = True
        letters, _, ends = joined(texts)
        found = []
        for a in range(0, len(letters), SLICE):
            part = letters[a : a + SLICE + max(ORDERS) - 1]
            for order in ORDERS:
                hashes = gram_hashes(part, order)[:SLICE]
                at = np.flatnonzero(seen[hashes >> np.uint32(32 - BITMAP_BITS)])
                which = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
                same = self.grams[which] == hashes[at]
                at, which = at[same] + a, which[same]
                text = np.searchsorted(ends, at, side="right")
                inside = at + order <= ends[text]
                found.append(text[inside] * len(self.grams) + which[inside])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.grams), pairs % len(self.grams)

    def score(self, texts: list[str]) -> np.ndarray:
        text, gram = self.present(texts)
        return sigmoid(self.bias + np.bincount(text, self.weights[gram], len(texts)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each batch of (label, text): hash, number of toxic texts with it, number of all."""
    for batch in batches:
        labels, hashes, toxic = batch.column(0).to_pylist(), [], []
        for label, text in zip(labels, batch.column(1).to_pylist(), strict=True):
            letters, _, _ = joined([text])
            own = np.unique(np.concatenate([np.unique(gram_hashes(letters, order)) for order in ORDERS]))
            hashes.append(own)
            toxic.append(np.full(len(own), label))
        if hashes:
            grams, place, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            marked = np.bincount(place, np.concatenate(toxic), len(grams)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int64)), pa.array(marked), pa.array(n)], names=["gram", "toxic", "n"])


def regression(text: np.ndarray, gram: np.ndarray, scale: np.ndarray, labels: np.ndarray, ridge: float, rounds: int) -> tuple[np.ndarray, float]:
    """Logistic regression on scaled presence by accelerated gradient descent; weights times scale, and intercept."""
    n, m = len(labels), len(scale)
    value = scale[gram]
    rate = 4 * n / (n + float(np.bincount(text, value**2, n).max(initial=0)) * n / 4 + ridge)
    w, b = np.zeros(m), float(np.log((labels.mean() + 1e-3) / (1 - labels.mean() + 1e-3)))
    v, c = w.copy(), b
    for k in range(rounds):
        error = sigmoid(np.bincount(text, value * v[gram], n) + c) - labels
        new_w = v - rate * (np.bincount(gram, value * error[text], m) + ridge * v) / n
        new_b = c - rate * error.mean()
        push = k / (k + 3)
        v, c = new_w + push * (new_w - w), new_b + push * (new_b - b)
        w, b = new_w, new_b
    return w * scale, b


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Model:
    """Learn from at most ``sample_rows`` labelled rows that are not held out, keeping at most ``features`` n-grams.

    Without rows of both labels the model gives every text a score near the share of label 1, or 0 without rows.
    """
    small_batches(docs.sparkSession)
    rows = staged(labelled.sample(docs, labels, label, sample_rows, id_column, text_column), "toxicity-sample")
    marks = rows.groupBy("label").count().collect()
    sizes = {row["label"]: row["count"] for row in marks}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model(np.zeros(0, np.uint32), np.zeros(0), 30.0 if toxic else -30.0)
    counts = (
        rows.select("label", "text")
        .mapInArrow(_counted, "gram long, toxic long, n long")
        .groupBy("gram")
        .agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_TEXTS)
    )
    ratio = F.log((F.col("toxic") + SMOOTH) / (toxic + 2 * SMOOTH)) - F.log((F.col("n") - F.col("toxic") + SMOOTH) / (clean + 2 * SMOOTH))
    kept = (
        counts.withColumn("ratio", ratio)
        .where(F.abs("ratio") >= LEAST_RATIO)
        .orderBy((F.abs("ratio") * F.sqrt("n")).desc(), "gram")
        .limit(features)
        .collect()
    )
    kept.sort(key=lambda row: row["gram"])
    grams = np.array([row["gram"] for row in kept], np.uint32)
    scale = np.array([row["ratio"] for row in kept])
    finder = Model(grams, scale, 0.0)

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, gram = finder.present(batch.column(2).to_pylist())
            lists = [gram[text == i].tolist() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "label", "grams"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "label", "text").mapInArrow(features_of, f"doc_id {kind}, label int, grams array<bigint>").toPandas()
    found = found.sort_values("doc_id", kind="stable")
    text = np.repeat(np.arange(len(found)), [len(x) for x in found["grams"]])
    gram = np.concatenate([np.zeros(0, np.int64), *found["grams"]]).astype(np.int64)
    weights, bias = regression(text, gram, scale, found["label"].to_numpy(float), RIDGE, ROUNDS)
    return Model(grams, weights, bias)


def score(text: str | Column, model: Model) -> Column:
    """Score from 0 to 1 of each whole text; higher is more likely toxic. A null text counts as empty."""

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()))

    return scores(text_of(text))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns and as often as they occur."""
    small_batches(docs.sparkSession)
    model = fit(docs, labels, id_column=id_column, text_column=text_column)
    return docs.where(score(text_column, model) < threshold)
