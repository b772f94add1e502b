"""Quality of documents by gradient-boosted trees over statistics of their text.

Statistics are counted in the tasks over whole texts; learning reads a bounded sample of labelled rows, of which the
driver receives the statistics alone. The trees are flattened into arrays, and a task walks all trees of a batch of
rows one level at a time.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toitscope.llm import boosting, labelled
from toitscope.llm.shared import small_batches, text_of

SAMPLE_ROWS = 10_000
THRESHOLD = 0.3

#: Groups of ASCII bytes whose share of a text is a statistic.
GROUPS = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b" ",
    b"\n\r\t\x0b\x0c",
    b".,;:",
    b"!?",
    b"|",
    b"#$%&*@^~+=_\\",
    b"<>[]{}()",
    b"\"'`",
    b"-/",
]
_MEMBER = np.zeros((256, len(GROUPS)))
for _i, _group in enumerate(GROUPS):
    _MEMBER[list(_group), _i] = 1.0
STATISTICS = len(GROUPS) + 14


def statistics(text: str) -> list[float]:
    """Numbers that describe one text; all are finite, also for an empty one."""
    data = text.encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, np.uint8)
    size = max(1, len(raw))
    shares = (np.bincount(raw, minlength=256) @ _MEMBER) / size
    words = text.split()
    n = max(1, len(words))
    kinds = set(words)
    lines = text.split("\n")
    filled = [line for line in lines if line.strip()]
    count = max(1, len(filled))
    lengths = np.fromiter(map(len, kinds), np.int64, len(kinds)) if kinds else np.zeros(1, np.int64)
    return [
        *shares.tolist(),
        float(np.count_nonzero(raw >= 128)) / size,
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        float(lengths.mean()),
        float(lengths.max()),
        len(kinds) / n,
        len(kinds) / float(np.sqrt(n)),
        len(zlib.compress(data, 1)) / size,
        float(np.log1p(len(lines))),
        n / count,
        len(set(filled)) / count,
        sum(line.rstrip()[-1] in ".!?\"'" for line in filled) / count,
        sum(map(str.isupper, kinds)) / max(1, len(kinds)),
    ]


def _table(texts: list[str]) -> np.ndarray:
    return np.array([statistics(text) for text in texts], float).reshape(len(texts), STATISTICS)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> boosting.Forest:
    """Trees learnt from at most ``sample_rows`` labelled rows that are not held out.

    Without rows of both labels every text has the share of label 1 as its score, or 1 without rows.
    """
    small_batches(docs.sparkSession)
    rows = labelled.sample(docs, labels, label, sample_rows, id_column, text_column)

    @F.pandas_udf("array<double>")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(text) for text in texts])

    found = rows.select("doc_id", "label", counted("text").alias("x")).toPandas().sort_values("doc_id", kind="stable")
    x = np.array(found["x"].tolist(), float).reshape(len(found), STATISTICS)
    y = found["label"].to_numpy(float)
    forest = boosting.fit(x, y)
    if not len(found):
        forest.bias = 30.0
    return forest


def score(text: str | Column, forest: boosting.Forest) -> Column:
    """Score from 0 to 1 of each whole text; higher is better. A null text counts as empty."""

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(forest.score(_table(texts.tolist())))

    return scores(text_of(text))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns and as often as they occur."""
    small_batches(docs.sparkSession)
    forest = fit(docs, labels, id_column=id_column, text_column=text_column)
    return docs.where(score(text_column, forest) >= threshold)
