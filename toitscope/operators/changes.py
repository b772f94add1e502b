"""Changes of stored rows that leave their files alone: removal and upsert by marks, and the compaction that ends them.

A removal reads what it needs to find its rows and writes bitmaps; an upsert writes the new versions of the rows it
meets, the rows it adds, and bitmaps over the old versions. Either writes in proportion to what it changes, whatever
the table holds. Readers pay for marks until ``compact`` has written the folders concerned anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.operators import kept
from toitscope.operators.commits import current, transaction
from toitscope.operators.keyed import upsert
from toitscope.operators.marks import FILE, POSITION
from toitscope.operators.storage import (
    MAX_ROWS_PER_FILE,
    PARTITIONS,
    add_folder,
    concerned,
    folders_of,
    hide,
    laid_out,
    place_folders,
    placed_rows,
    staged,
    staging,
)
from toitscope.schemas import TABLES, UNIQUE_KEYS


def _met(
    spark: SparkSession, warehouse: str, table: str, given: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame | None:
    """``columns`` and places of the stored rows that have a key of ``given``; staged.

    The range of the first key reaches the scan as a filter: rows are sorted by commune inside files, so a removal of
    few communes opens few row groups.
    """
    at = current(spark, warehouse)
    folders = at.folders(table)
    where = [*place_folders(table), FILE, POSITION]
    low, high = given.agg(F.min(keys[0]), F.max(keys[0])).first()
    if not folders or low is None:
        return None
    rows = placed_rows(spark, warehouse, table, folders, at).where(F.col(keys[0]).between(low, high))
    found = rows.join(given.select(*keys), keys, "left_semi")
    return staged(found.select(*columns, *[n for n in where if n not in columns]), f"{table}-met")


def remove_rows(spark: SparkSession, warehouse: str, table: str, gone: DataFrame, key: str) -> None:
    """Remove the stored rows whose ``key`` is among those of ``gone``; a null key removes nothing.

    Another writer's removal from the same folders stays beside this one; if one of the folders is rewritten, it is a
    conflict, and so is any change of the table if it has a unique key.
    """
    with staging(spark), transaction(spark, warehouse) as work:
        if table in UNIQUE_KEYS:
            work.rely_on(table)
        keys = staged(gone.select(key).where(F.col(key).isNotNull()).distinct(), "gone")
        counted = table == kept.SALES and kept.keeps_counts(work)
        met = _met(spark, warehouse, table, keys, [key], kept.COLUMNS if counted else [])
        if met is not None:
            hide(met, warehouse, table)
            if counted:
                kept.take_away(spark, warehouse, met)


def merge_rows(
    incoming: DataFrame,
    warehouse: str,
    table: str,
    update: list[str],
    fill: dict[str, Column] | None = None,
    keep_missing: bool = False,
    touch: dict[str, Column] | None = None,
) -> None:
    """``upsert`` of ``incoming`` (each key once) into a table with a unique key; rows it does not meet stay where they are."""
    spark, keys = incoming.sparkSession, UNIQUE_KEYS[table]
    with staging(spark), transaction(spark, warehouse) as work:
        work.rely_on(table)
        given = staged(incoming.select(*keys, *update), f"{table}-given")
        names = TABLES[table].names
        met = _met(spark, warehouse, table, given, keys, names)
        old = spark.createDataFrame([], TABLES[table]) if met is None else met.select(*names)
        fresh = upsert(old, given, keys, update, fill, keep_missing, touch)
        # The marks are found before the new folder is listed: they concern older ones only.
        if met is not None:
            hide(met, warehouse, table)
        add_folder(fresh, warehouse, table, f"merged-{uuid.uuid4().hex}")


def compact(spark: SparkSession, warehouse: str, table: str) -> list[str]:
    """Write the folders of which rows were removed anew, without these rows; returns the folders it replaced.

    Loads keep their ids, so one that is repeated still replaces what it left. A folder without removed rows is not
    touched. Whoever removes rows from one of the folders meanwhile is in conflict with this.
    """
    with transaction(spark, warehouse) as work:
        old = concerned(work, table, work.folders(table))
        if not old:
            return []
        rows = placed_rows(spark, warehouse, table, old, work)
        inner = ["load_id", *PARTITIONS.get(table, [])]
        laid = laid_out(rows.select(*TABLES[table].names, "load_id"), table)
        commit = f"commit={uuid.uuid4().hex}"
        writer = laid.write.partitionBy(*inner).option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        writer.parquet(f"{warehouse}/{table}/{commit}")
        work.remove(table, old)
        new = [f"{commit}/{folder}" for folder in folders_of(spark, f"{warehouse}/{table}/{commit}", "load_id=")]
        for folder in new:
            work.add(table, folder)
        if table == kept.SALES:
            kept.carry_over(spark, warehouse, old, new)
        return old
