"""Delimited files read by header name, with row position and damaged-row marks.

Every source comes out as text columns plus

* ``_pos``    -- place of the row: file, block of the file, running number. Rows of one block are read
  in order by one task, so the running number is needed only within a block.
* ``_damage`` -- NULL, ``short_row`` (fewer fields than the header), ``bad_encoding`` (text that was
  not valid UTF-8) or ``open_quote`` (a line behind a quote that nobody closed). A row with surplus fields is kept;
  the surplus is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toitscope.functions.text import any_of
from toitscope.schemas import Source
from toitscope.sources.quoted import located_lines, parsed, records

CORRUPT = "_corrupt_record"
REPLACEMENT = "�"
PARTITION_COLUMNS = ("year", "dept")


def csv_options(separator: str, multi_line: bool = False) -> dict[str, object]:
    return {
        "header": True,
        "sep": separator,
        "encoding": "UTF-8",
        "escape": '"',
        "multiLine": multi_line,
        # A file whose header differs from the schema fails instead of shifting columns.
        "enforceSchema": False,
        # The damage mark is lost when the parser skips unread columns.
        "columnPruning": False,
        "columnNameOfCorruptRecord": CORRUPT,
    }


def header_schema(
    spark: SparkSession,
    path: str | list[str],
    separator: str,
    glob: str | None = None,
    folders: bool = True,
) -> T.StructType:
    """All-text schema named by the header; with ``folders`` also the folder columns (year, dept)."""
    reader = spark.read.option("header", True).option("sep", separator).option("escape", '"')
    reader = reader.option("recursiveFileLookup", not folders)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    names = reader.csv(path).columns
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    source: Source,
    separator: str | None = None,
    glob: str | None = None,
    multi_line: bool = False,
    folders: Column | None = None,
    quoted_breaks: bool = False,
) -> DataFrame:
    """Batch read of one source. ``quoted_breaks`` allows line breaks in quotes: lines are staged, from splits.

    ``multi_line`` allows them too, in one read, but stops file splitting.
    ``folders`` is a condition on the folder columns. It applies before rows are numbered: a filter put on the
    result would not get past the numbering and every file would be opened.
    """
    separator = separator or source.separator
    schema = header_schema(spark, path, separator, glob)
    if quoted_breaks:
        text = spark.read.option("pathGlobFilter", glob) if glob else spark.read
        scanned = text.schema(text_schema(schema)).format("text").load(path)
        return shape(joined_lines(located_lines(scanned if folders is None else scanned.where(folders)), schema, separator), schema, source)
    reader = spark.read.schema(with_corrupt(schema)).options(**csv_options(separator, multi_line))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    scanned = reader.csv(path)
    if folders is not None:
        scanned = scanned.where(folders)
    return shape(located(scanned), schema, source)


def text_schema(schema: T.StructType) -> T.StructType:
    """A line and the folder columns."""
    return T.StructType([T.StructField("value", T.StringType()), *[f for f in schema.fields if f.name in PARTITION_COLUMNS]])


def joined_lines(lines: DataFrame, schema: T.StructType, separator: str) -> DataFrame:
    """Located lines as a located scan: fields may hold line breaks in quotes."""
    names = [name for name in schema.names if name not in PARTITION_COLUMNS]
    return parsed(records(lines, separator), names, separator, CORRUPT)


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def located(scanned: DataFrame) -> DataFrame:
    """Adds the file and the block of the file each row of a scan comes from."""
    return scanned.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def shape(scanned: DataFrame, schema: T.StructType, source: Source) -> DataFrame:
    """Pick the source's columns out of a ``located`` scan, number the rows and mark damaged ones."""
    present = set(schema.names)
    missing = [name for name in source.required if name not in present]
    if missing:
        raise ValueError(f"{source.name}: no column {missing} in header {schema.names}")
    folders = [name for name in PARTITION_COLUMNS if name in present]
    last_header = [name for name in schema.names if name not in folders][-1]

    def text(name: str):
        return F.col(f"`{name}`") if name in present else F.lit("")

    wanted = source.columns + [name for name in source.optional if name in present]
    short = F.col(CORRUPT).isNotNull() & text(last_header).isNull()
    lost = F.col("_open") if "_open" in scanned.columns else F.lit(False)
    row = F.col("_row") if "_row" in scanned.columns else F.monotonically_increasing_id()
    garbled = any_of(*[F.coalesce(text(name), F.lit("")).contains(REPLACEMENT) for name in wanted])
    return scanned.select(
        *[text(name).alias(name) for name in wanted],
        *folders,
        F.struct(
            F.col("_file").alias("file"),
            F.col("_block").alias("block"),
            row.alias("row"),
        ).alias("_pos"),
        F.when(lost, F.lit("open_quote")).when(short, F.lit("short_row")).when(garbled, F.lit("bad_encoding")).alias("_damage"),
    )
