"""Stored tables and SQL with named parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(spark: SparkSession, sql: str, params: dict[str, object] | None = None, **tables: DataFrame) -> DataFrame:
    """Run SQL with ``:name`` parameters; ``tables`` are visible to it under their keyword names, and only to it."""
    views = {name: f"_{uuid.uuid4().hex}" for name in tables}
    for name, view in views.items():
        tables[name].createOrReplaceTempView(view)
    named = ", ".join(f"{name} AS (SELECT * FROM {view})" for name, view in views.items())
    try:
        return spark.sql(f"WITH {named} SELECT * FROM (\n{sql}\n)" if named else sql, args=params or {})
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counted = [
        df.agg(F.count("*").alias("nb_records")).select(F.lit(name).alias("table_name"), "nb_records")
        for name, df in tables.items()
    ]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out
