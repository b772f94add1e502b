"""Parquet tables in a warehouse folder.

A table consists of load folders, ``<warehouse>/<table>/commit=<unique>/load_id=<load>/``, as listed by the last commit.
A load writes its own folder through Spark's commit protocol and then commits it; one that is repeated under its id
replaces the folder it left. Rewrites write a folder that replaces those they have read. Rows can also be removed by
marks, ``<warehouse>/<table>_marks/marks=<unique>/``, which readers apply to the folders they concern. Readers keep to
the commit they began with.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.operators.commits import Snapshot, Transaction, current, exists, transaction
from toitscope.operators.marks import FILE, MARKS_SCHEMA, POSITION, bitmaps, place, unmarked
from toitscope.schemas import DEFAULTS, TABLES, UNIQUE_KEYS
from toitscope.session import shared_folder

PARTITIONS = {"transactions": ["year"]}
# Tables that hold something about each load folder of another one, which is out of date when rows of it are removed.
DERIVED = {"transactions": ["transactions_keys"]}
MAX_ROWS_PER_FILE = 5_000_000
_staging: ContextVar[str | None] = ContextVar("staging", default=None)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An append-only Parquet log; empty before its first row."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A folder in the shared one for what is staged meanwhile; it goes at the end, whatever the outcome."""
    if _staging.get():
        yield _staging.get()
        return
    path = f"{shared_folder(spark)}/staging/{uuid.uuid4().hex}"
    token = _staging.set(path)
    try:
        yield path
    finally:
        _staging.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, name: str, split: str | None = None, lasting: bool = False) -> DataFrame:
    """``df`` written to the folder of the running ``staging`` and read back, in folders by the text column ``split``.

    What is ``lasting`` can also be staged outside of it, in a folder that goes when the driver's session ends.
    """
    spark = df.sparkSession
    if not _staging.get() and not lasting:
        raise RuntimeError("rows are staged only inside staging()")
    path = f"{_staging.get() or shared_folder(spark) + '/staging'}/{name}-{uuid.uuid4().hex}"
    if not _staging.get():
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    writer = df.write.partitionBy(split) if split else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(
    spark: SparkSession,
    warehouse: str,
    table: str,
    folders: list[str] | None = None,
    at: Snapshot | Transaction | None = None,
) -> DataFrame:
    """Rows of a target table as of the running transaction or the last commit, or as of ``at``, or of some folders.

    An empty frame of the table's schema before the first load. A folder that is listed and gone is an error, not an
    empty table. Folders without removed rows are read as they are; only the others meet their marks.
    """
    at = at or current(spark, warehouse)
    names = [*TABLES[table].names, *PARTITIONS.get(table, [])]
    folders = at.folders(table) if folders is None else folders
    if not folders:
        return spark.createDataFrame([], ", ".join(_columns(table)))
    marked = concerned(at, table, folders)
    whole = [folder for folder in folders if folder not in marked]
    parts = [_files(spark, warehouse, table, whole).select(*names)] if whole else []
    if marked:
        parts.append(placed_rows(spark, warehouse, table, marked, at).select(*names))
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def _columns(table: str) -> list[str]:
    columns = [f"{f.name} {f.dataType.simpleString()}" for f in TABLES[table]]
    return columns + [f"{name} int" for name in PARTITIONS.get(table, [])]


def _files(spark: SparkSession, warehouse: str, table: str, folders: list[str]) -> DataFrame:
    """Rows of load folders as they were written, with the names of these."""
    layout = ", ".join([*_columns(table), "commit string", "load_id string"])
    reader = spark.read.schema(layout).option("basePath", f"{warehouse}/{table}")
    return reader.parquet(*[f"{warehouse}/{table}/{folder}" for folder in folders])


def concerned(at: Snapshot | Transaction, table: str, folders: list[str]) -> list[str]:
    """The folders of which rows were removed by marks."""
    marked = {folder for on in at.marks(table).values() for folder in on}
    return [folder for folder in folders if folder in marked]


def placed_rows(
    spark: SparkSession, warehouse: str, table: str, folders: list[str], at: Snapshot | Transaction
) -> DataFrame:
    """Rows of these folders that no mark hides, with their place and the names of their folders."""
    rows = _files(spark, warehouse, table, folders).select("*", *place())
    marks = [name for name, on in at.marks(table).items() if set(on) & set(folders)]
    if not marks:
        return rows
    keys = place_folders(table)
    layout = ", ".join([MARKS_SCHEMA, *[f"{name} int" for name in PARTITIONS.get(table, [])]])
    hidden = spark.read.schema(layout).parquet(*[f"{warehouse}/{table}_marks/{name}" for name in marks])
    return unmarked(rows, hidden, keys)


def place_folders(table: str) -> list[str]:
    return ["commit", "load_id", *PARTITIONS.get(table, [])]


def hide(places: DataFrame, warehouse: str, table: str) -> None:
    """Remove the rows at ``places`` (from ``placed_rows``, staged) by writing their marks; the rows' files stay."""
    spark = places.sparkSession
    keys = place_folders(table)
    name = f"marks={uuid.uuid4().hex}"
    with transaction(spark, warehouse) as work:
        # One row per load folder, of which the driver has the list anyway.
        rows = places.select("commit", "load_id").distinct().collect()
        touched = {f"commit={row['commit']}/load_id={row['load_id']}" for row in rows}
        folders = [folder for folder in work.folders(table) if unquote(folder) in touched]
        if not folders:
            return
        bitmaps(places.select(*keys, FILE, POSITION), keys).write.parquet(f"{warehouse}/{table}_marks/{name}")
        work.mark(table, name, folders)
        for other in DERIVED.get(table, []):
            work.rely_on(other)
            work.remove(other, [f for f in work.folders(other) if f.rpartition("/")[0] in folders])


def with_defaults(df: DataFrame, table: str, now=None) -> DataFrame:
    """All columns of the target: defaults where a value is missing, typed NULL where none is declared."""
    stamp = F.localtimestamp() if now is None else now
    present = set(df.columns)

    def column(spec):
        value = F.col(spec.name) if spec.name in present else F.lit(None)
        if spec.name in DEFAULTS[table]:
            default = DEFAULTS[table][spec.name]
            value = F.coalesce(value, stamp if default == "now" else F.lit(default))
        return value.cast(spec.dataType).alias(spec.name)

    return df.select(*[column(spec) for spec in TABLES[table].fields])


def laid_out(df: DataFrame, table: str) -> DataFrame:
    """Adds the folder column and sorts inside each task, so that file statistics serve commune filters."""
    above = [name for name in ("load_id",) if name in df.columns]
    if table == "transactions":
        return df.withColumn("year", F.year("date_transaction")).sortWithinPartitions(*above, "year", "commune_id")
    if "commune_id" in df.columns:
        return df.sortWithinPartitions(*above, "commune_id")
    return df


def append(df: DataFrame, warehouse: str, table: str, load_id: str | None = None) -> None:
    """Add a batch; all of it appears, or nothing, and once under its ``load_id``.

    Appends of several writers all stay. Where rows have a unique key, a change by another writer is a conflict.
    """
    spark = df.sparkSession
    load_id = load_id or uuid.uuid4().hex
    with transaction(spark, warehouse) as work:
        if table in UNIQUE_KEYS:
            work.rely_on(table)
        folder = _write(df, warehouse, table, load_id)
        work.remove(table, [f for f in work.folders(table) if f.endswith(f"/load_id={load_id}")])
        work.add(table, folder)


def replace(df: DataFrame, warehouse: str, table: str) -> None:
    """Write ``df`` (which may read the table) in place of the folders there are now.

    What others append meanwhile stays, unless the table has a unique key; if they replace one of these folders, it is
    a conflict. To cover the reading of the table as well, call both in one ``transaction``.
    """
    with transaction(df.sparkSession, warehouse) as work:
        if table in UNIQUE_KEYS:
            work.rely_on(table)
        old = work.folders(table)
        folder = _write(df, warehouse, table, "rewritten")
        work.remove(table, old)
        work.add(table, folder)


def add_folder(df: DataFrame, warehouse: str, table: str, load_id: str) -> None:
    """Write a load folder beside those there are, inside a transaction that has checked what has to be checked."""
    with transaction(df.sparkSession, warehouse) as work:
        work.add(table, _write(df, warehouse, table, load_id))


def folders_of(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names of the folders right under ``path`` that begin with ``prefix``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    names = [status.getPath().getName() for status in found if status.isDirectory()]
    return sorted(name for name in names if name.startswith(prefix))


def _write(df: DataFrame, warehouse: str, table: str, load_id: str) -> str:
    """Write a load folder and return its name."""
    folder = f"commit={uuid.uuid4().hex}/load_id={load_id}"
    writer = laid_out(df.select(*TABLES[table].names), table).write
    writer = writer.option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
    partitions = PARTITIONS.get(table)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{warehouse}/{table}/{folder}")
    return folder
