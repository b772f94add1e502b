"""Indicators that set sales against population and income, and equipment per commune."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toitscope.plans.prices import sale_stats


def affordability(transactions: DataFrame, demographics: DataFrame) -> DataFrame:
    """Per commune and year: years of median income a median sale costs, and sales per 1,000 inhabitants."""
    keys = ["commune_id", "annee"]
    dated = transactions.withColumn("annee", F.year("date_transaction"))
    figures = sale_stats(dated, keys, ["prix", "prix_m2"])
    people = demographics.select(*keys, "population", "revenu_median")
    years = F.try_divide(F.col("prix_median"), F.col("revenu_median").cast("double"))
    rate = F.try_divide(F.lit(1000.0) * F.col("nb_transactions"), F.col("population"))
    return figures.join(people, keys).select(
        *keys,
        "nb_transactions",
        "prix_median",
        "prix_m2_median",
        "population",
        "revenu_median",
        F.round(years, 4).alias("years_of_income"),
        F.round(rate, 4).alias("sales_per_1000"),
    )


def equipment_counts(infrastructure: DataFrame) -> DataFrame:
    """Units of each equipment type per commune."""
    return infrastructure.groupBy("commune_id", "type_equipement").agg(F.sum("nombre").alias("nombre"))


def equipment_table(infrastructure: DataFrame, types: list[str]) -> DataFrame:
    """One row per commune, one column per equipment type, 0 where there is none."""
    sums = [
        F.sum(F.when(F.col("type_equipement") == kind, F.col("nombre")).otherwise(0)).alias(kind)
        for kind in types
    ]
    return infrastructure.groupBy("commune_id").agg(*sums)
