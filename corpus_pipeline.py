"""Corpus preparation: toxic and poor documents go, repeated passages and near copies go, the rest is packed.

Every stage works on all rows its predecessor kept. All but the last return the columns of ``documents``; the last
returns the pieces of the packed sequences. Each stage's rows are written to the shared folder and read again, so a
lost executor costs a stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from toitscope.llm import line_dedup, near_dedup, packing, quality, toxicity
from toitscope.llm.shared import staged, step_of
from toitscope.sources.tables import parquet_table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity."""
    return toxicity.drop_toxic(docs, parquet_table(spark, sf_dir, "labels"))


def of_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more for quality."""
    return quality.keep_good(docs, parquet_table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand earlier in the corpus."""
    return line_dedup.drop_repeated_lines(docs, whole=True)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return near_dedup.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 2048 tokens."""
    parts = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, find_added=True)
    return packing.pack(parts)


STAGES = [
    ("toxicity", without_toxic),
    ("quality", of_good_quality),
    ("line dedup", without_repeated_lines),
    ("near dedup", without_near_copies),
    ("packing", packed),
]

#: Training and signatures have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after the other."""
    docs = parquet_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with step_of(spark) as kept:
            docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            kept.append(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
