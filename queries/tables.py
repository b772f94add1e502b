"""The driver's tables in the shape of the library's targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.functions.measures import price_per_m2
from toitscope.sources.tables import parquet_table, query

AS_OF = "2001-11-30"
RUNS_AS_OF = "2024-01-30 00:00:00"
EQUIPMENT = ["STANDARD", "MEDIUM", "ECONOMY", "PROMO", "SMALL", "LARGE"]


class Tables:
    """Lazy access to the tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return parquet_table(self.spark, self.folder, name)

    def raw(self, sql: str, *names: str) -> DataFrame:
        """Dirty text by the shared SQL."""
        return query(self.spark, sql, **{name: getattr(self, name) for name in names})

    def communes(self) -> DataFrame:
        placed = self.supplier.join(self.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
            self.region, F.col("n_regionkey") == F.col("r_regionkey")
        )
        return placed.select(
            F.col("s_suppkey").cast("string").alias("code_insee"),
            F.col("s_name").alias("nom"),
            F.col("n_name").alias("dept"),
            F.col("r_name").alias("region"),
        )

    def sales(self, *more: Column) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        area = F.col("l_quantity").cast("decimal(10,2)")
        return self.lineitem.select(
            F.col("l_suppkey").cast("string").alias("commune_id"),
            F.col("l_shipdate").cast("date").alias("date_transaction"),
            price.alias("prix"),
            area.alias("surface"),
            price_per_m2(price, area).cast("decimal(10,2)").alias("prix_m2"),
            F.col("l_returnflag").alias("type_bien"),
            *more,
        )

    def diagnoses(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_suppkey").cast("string").alias("commune_id"),
            F.char(F.lit(64) + F.col("l_linenumber")).alias("classe_energetique"),
            F.col("l_quantity").cast("decimal(10,2)").alias("consommation_energie"),
            F.col("l_tax").cast("decimal(10,2)").alias("emissions_co2"),
        )

    def runs(self) -> DataFrame:
        """Events as runs: ``k`` of the payload sets the state, ``value`` the length in seconds."""
        k = F.get_json_object("props", "$.k").cast("int")
        status = F.when(k < 70, "success").when(k < 90, "failed").otherwise("running")
        length = F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
        return self.events.select(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("scraper_name"),
            F.col("ts").alias("started_at"),
            F.when(k < 90, F.col("ts") + length).alias("completed_at"),
            status.alias("status"),
            F.when(k < 70, k.cast("bigint") * 10).otherwise(F.lit(0).cast("bigint")).alias("records_processed"),
            F.col("props").alias("metadata"),
        )

    def demographics(self) -> DataFrame:
        """Per supplier and year of its sales: an income and a population that vary with both."""
        base = self.lineitem.groupBy(
            F.col("l_suppkey").cast("string").alias("commune_id"), F.year("l_shipdate").alias("annee")
        ).agg(F.sum(F.col("l_quantity").cast("int")).cast("int").alias("population"))
        income = (F.col("annee") * 10).cast("decimal(10,2)")
        return base.withColumn("revenu_median", income)

    def infrastructure(self) -> DataFrame:
        joined = self.lineitem.join(self.part, F.col("l_partkey") == F.col("p_partkey"))
        return joined.select(
            F.col("l_suppkey").cast("string").alias("commune_id"),
            F.col("p_type").alias("type_equipement"),
            F.col("l_quantity").cast("int").alias("nombre"),
        )
