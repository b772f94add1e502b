"""Bitmaps of removed rows, by file: a row is known by its file and its position in it.

A bitmap covers 32,768 positions of one file, so a removal costs an eighth of a byte for each row of the stretches it
touches, and a reader meets every row with at most one bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE, POSITION = "_file", "_position"
MARKS_SCHEMA = "commit string, load_id string, _file string, _bucket bigint, _bits binary"


def place() -> list[Column]:
    """Where a row read from Parquet lies: the name of its file, which its folders make unique, and its position from 1."""
    return [F.col("_metadata.file_name").alias(FILE), (F.col("_metadata.row_index") + 1).alias(POSITION)]


def bitmaps(places: DataFrame, folders: list[str]) -> DataFrame:
    """The rows at ``places`` as bitmaps, by the ``folders`` columns, file and stretch; a place may be named repeatedly."""
    stretch = F.bitmap_bucket_number(POSITION).alias("_bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(POSITION)).alias("_bits")
    return places.groupBy(*folders, FILE, stretch).agg(bits)


def united(marks: DataFrame, folders: list[str]) -> DataFrame:
    """One bitmap for each stretch, from those of several removals."""
    return marks.groupBy(*folders, FILE, "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))


def unmarked(placed: DataFrame, marks: DataFrame, folders: list[str]) -> DataFrame:
    """Rows whose bit is not set. Spark broadcasts the bitmaps while they are small and merges them beyond that."""
    rows = placed.withColumn("_bucket", F.bitmap_bucket_number(POSITION))
    met = rows.join(united(marks, folders), [*folders, FILE, "_bucket"], "left")
    bit = F.bitmap_bit_position(POSITION)
    octet = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hidden = F.getbit(octet, (bit % 8).cast("int")) == 1
    return met.where(F.col("_bits").isNull() | ~hidden).drop("_bucket", "_bits")
