"""Deliveries that repeat what is stored: an index of row fingerprints beside every load folder of the sales.

A fingerprint is a digest of all delivered values of a row; the index has one row for each of a folder's different
rows, with the number of its copies, in year folders and sorted by commune and day. A delivery is compared with the
part of the index that its years, communes and days reach, so stored rows themselves are not read. Folders get their
index when a delivery first asks for it; it is committed with the rows it describes and goes with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.operators.commits import current
from toitscope.operators.keyed import COPY_CHUNK, deal_copies
from toitscope.operators.storage import MAX_ROWS_PER_FILE, read_table
from toitscope.schemas import TABLES

SALES, INDEX = "transactions", "transactions_keys"
INDEX_SCHEMA = "fingerprint binary, commune_id string, date_transaction date, copies bigint, year int"


def delivered_columns() -> list[str]:
    """What a delivery says of a sale; the stamp of its load is not part of it."""
    return [name for name in TABLES[SALES].names if name != "created_at"]


def fingerprint(columns: list[str]) -> Column:
    """128 bits of all values; a null is unlike any value."""
    return F.unhex(F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")))


def keys_of(sales: DataFrame) -> DataFrame:
    """One row for each different sale; copies are counted in each task first."""
    marked = sales.select(
        fingerprint(delivered_columns()).alias("fingerprint"), "commune_id", "date_transaction", F.year("date_transaction").alias("year")
    )
    counted = marked.groupBy("fingerprint", "commune_id", "date_transaction", "year").agg(F.count("*").alias("copies"))
    return counted.select("fingerprint", "commune_id", "date_transaction", "copies", "year")


def index_sales(spark: SparkSession, warehouse: str) -> dict[str, str]:
    """Give every load folder of the running transaction's sales its index; the folder of the index by that of the rows.

    Another writer's change of the index is a conflict, so no folder is counted twice.
    """
    work = current(spark, warehouse)
    work.rely_on(INDEX)
    found = {folder.rpartition("/")[0]: folder for folder in work.folders(INDEX)}
    folders = work.folders(SALES)
    work.remove(INDEX, [found.pop(folder) for folder in sorted(set(found) - set(folders))])
    for folder in folders:
        if folder not in found:
            rows = keys_of(read_table(spark, warehouse, SALES, [folder]))
            laid = rows.repartition("year", F.substring("commune_id", 1, 2)).sortWithinPartitions("year", "commune_id", "date_transaction")
            found[folder] = f"{folder}/index={uuid.uuid4().hex}"
            laid.write.partitionBy("year").option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(f"{warehouse}/{INDEX}/{found[folder]}")
            work.add(INDEX, found[folder])
    return found


def read_index(spark: SparkSession, warehouse: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], INDEX_SCHEMA)
    names = "commit string, load_id string, index string"
    reader = spark.read.schema(f"{INDEX_SCHEMA}, {names}").option("basePath", f"{warehouse}/{INDEX}")
    return reader.parquet(*[f"{warehouse}/{INDEX}/{folder}" for folder in folders]).drop("commit", "load_id", "index")


def reached(index: DataFrame, batch: DataFrame) -> DataFrame:
    """The part of an index that a batch can meet: its years and ranges of communes and days, as filters on files."""
    day = F.col("date_transaction")
    seen = batch.agg(
        F.min("commune_id"), F.max("commune_id"), F.min(day), F.max(day), F.collect_set(F.year(day))
    ).first()
    if not seen[4]:
        return index.where("false")
    # One value per year reaches the driver.
    inside = F.col("commune_id").between(seen[0], seen[1]) & day.between(seen[2], seen[3])
    return index.where(F.col("year").isin(seen[4]) & inside)


def new_sales(batch: DataFrame, warehouse: str, load_id: str, chunk: int = COPY_CHUNK) -> DataFrame:
    """Rows of ``batch`` beyond the copies that other loads have stored; a sale repeated inside the batch stays so.

    What an earlier attempt of this load left does not count. Another writer's change of the sales is a conflict.
    """
    spark = batch.sparkSession
    columns = delivered_columns()
    current(spark, warehouse).rely_on(SALES)
    others = [index for folder, index in index_sales(spark, warehouse).items() if not folder.endswith(f"/load_id={load_id}")]
    stored = reached(read_index(spark, warehouse, others), batch)
    known = stored.groupBy("fingerprint").agg(F.sum("copies").alias("_known"))
    counted = batch.groupBy(*columns).agg(F.count("*").alias("_given")).withColumn("fingerprint", fingerprint(columns))
    surplus = counted.join(known, "fingerprint", "left").withColumn("_copies", F.col("_given") - F.coalesce("_known", F.lit(0)))
    return deal_copies(surplus.where("_copies > 0").select(*columns, "_copies"), columns, chunk)
