"""The labelled rows a classifier may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toitscope.llm.shared import text_of

FOLDS = 5


def held_out(doc_id: str | Column) -> Column:
    """Rows kept for judging a classifier: one fifth, by the checksum of the id as text (a null id counts as empty)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, label, text`` of at most ``rows`` labelled documents that are not held out, the same ones every time.

    Null ids and null labels are left out; an id with several labels counts as 1 if any is 1; an id with several
    texts gives the smallest.
    """
    marks = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    # The broadcast side has ``rows`` rows of two numbers at most.
    return texts.join(F.broadcast(marks), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
