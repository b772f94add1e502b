"""Exact duplicates of whole texts by progressive refinement: length, then prefix hash, then full hash.

Each level looks only at rows whose group of the level before has a second row. Groups are formed by aggregates
that combine inside each task before the shuffle, so a text copied into a third of all rows sends one row per task.
What a group decides returns to its rows by joins of narrow rows, which Spark splits where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toitscope.llm.shared import staged, text_of

#: The blanks that do not count, U+0020 and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
PREFIX_CHARS = 64


def normalised(text: str | Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.translate(text_of(text), BLANKS, "")


def copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    digest_all: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they agree after all blanks are deleted. Of equal texts the one with the most code points
    in its original form stays, then the smallest id, a null id last. Null and empty texts are equal to each other.
    Rows that agree in text, length and id with the one that stays are kept too: nothing tells them apart. Other
    columns of ``docs`` are not read, whatever their names; an empty table gives none.

    The full hash is taken of rows that share length and prefix hash with another, and ``text_sha256`` is null for
    the rest. A caller that needs the digest of every row anyway sets ``digest_all``: it is then taken in the scan
    that finds length and prefix, and no text is read twice.
    """
    text = text_of(text_column)
    read = docs.select(
        F.col(id_column).alias("doc_id"), F.length(text).alias("points"), normalised(text).alias("body")
    ).withColumns(
        {
            "size": F.octet_length("body"),
            "prefix": F.xxhash64(F.substring("body", 1, prefix_chars)),
            "full": F.sha2("body", 256),
        }
    )
    narrow = ["doc_id", "points", "size", "prefix"]
    rows = staged(read.select(*narrow, *(["full"] if digest_all else [])), "copies")
    by_prefix = rows.groupBy("size", "prefix").agg(F.count("*").alias("n"))
    sizes = by_prefix.groupBy("size").agg(F.sum("n").alias("n")).where("n > 1").select("size")
    alive = by_prefix.where("n > 1").join(sizes, "size", "left_semi").select("size", "prefix")
    if digest_all:
        survivors = rows.join(alive, ["size", "prefix"], "left_semi")
    else:
        alive = staged(alive, "copies-alive")
        survivors = staged(read.join(alive, ["size", "prefix"], "left_semi").select(*narrow, "full"), "copies-full")
        single = rows.join(alive, ["size", "prefix"], "left_anti")
        rows = survivors.unionByName(single.withColumn("full", F.lit(None).cast("string")))
    # Full hash and length alone name a group, and unlike the key of the join above they need a shuffle of their own:
    # Spark can then split a hot length and prefix, and partial groups are what it sends. Groups are stored so that
    # the last join reads both its sides from shuffles, which lets it split a hot text.
    groups = staged(
        survivors.groupBy("full", "size")
        .agg(
            F.count("*").alias("n"),
            F.min(F.struct((-F.col("points")).alias("longest"), F.col("doc_id").isNull().alias("unnamed"), "doc_id")).alias("stays"),
        )
        .where("n > 1"),
        "copies-groups",
    )
    alone = F.col("n").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id"))
    stays = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("points") == -F.col("stays.longest"))
    return rows.join(groups, ["full", "size"], "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("n")).cast("bigint").alias("group_size"),
        (alone | stays).alias("kept"),
        F.col("full").alias("text_sha256"),
    )
