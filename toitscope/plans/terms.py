"""Term counts behind a word cloud."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toitscope.operators.ranking import first_n_per_group

# A term is a run of letters; everything else separates.
NOT_LETTERS = r"[^\p{L}]+"


def term_counts(texts: DataFrame, group: str, text: str, min_length: int = 1) -> DataFrame:
    """(group, term, nb): occurrences of each lower-cased term over whole texts."""
    words = F.split(F.lower(F.col(text)), NOT_LETTERS)
    return (
        texts.select(group, F.explode(words).alias("term"))
        .where(F.char_length("term") >= min_length)
        .groupBy(group, "term")
        .agg(F.count("*").alias("nb"))
    )


def top_terms(texts: DataFrame, group: str, text: str, n: int, min_length: int = 1) -> DataFrame:
    """The ``n`` most frequent terms of each group; the alphabet breaks ties."""
    return first_n_per_group(term_counts(texts, group, text, min_length), [group], [F.desc("nb"), F.asc("term")], n)
