"""Price figures of a warehouse from the counts kept beside its sales.

They are those of ``prices`` and ``areas`` over the stored sales and register; the sales are not read where there are
counts (``operators.kept``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.operators.kept import PRICES, read_amounts, read_sums
from toitscope.operators.storage import read_table
from toitscope.plans.areas import area_members, by_level, one_area, year_on_year
from toitscope.plans.prices import first_day_of_window, of_register, per_department, stats_of_counts


def _figures(spark: SparkSession, warehouse: str, since: Column | None = None, members: DataFrame | None = None) -> DataFrame:
    keys = ["commune_id"]
    sums = read_sums(spark, warehouse, keys, since)
    return stats_of_counts(read_amounts(spark, warehouse, keys, PRICES, since), sums, keys, PRICES, members, mean_surface=True)


def kept_price_stats(spark: SparkSession, warehouse: str, as_of: Column | None = None) -> DataFrame:
    """``price_stats``: the trailing year as days and whole years."""
    return of_register(_figures(spark, warehouse, first_day_of_window(as_of)), read_table(spark, warehouse, "communes"))


def kept_stats_by_level(spark: SparkSession, warehouse: str) -> DataFrame:
    """``stats_by_level`` of all stored sales."""
    return by_level(_figures(spark, warehouse, members=area_members(read_table(spark, warehouse, "communes"))))


def kept_yearly_prices(spark: SparkSession, warehouse: str, area: str = "dept") -> DataFrame:
    """``yearly_prices`` per area."""
    keys, price = ["commune_id", "year"], PRICES[:1]
    found = [read_amounts(spark, warehouse, keys, price), read_sums(spark, warehouse, keys, measures=price)]
    counts, sums = [df.withColumnRenamed("year", "annee") for df in found]
    members = one_area(read_table(spark, warehouse, "communes"), area)
    return year_on_year(stats_of_counts(counts, sums, ["commune_id", "annee"], PRICES[:1], members))


def kept_department_prices(spark: SparkSession, warehouse: str) -> DataFrame:
    """``department_prices`` of all stored sales; block totals are enough."""
    spent = (F.sum("total").cast("decimal(36,0)") / 100).alias("total")
    per_commune = (
        read_sums(spark, warehouse, ["commune_id"], measures=PRICES[:1])
        .groupBy("commune_id")
        .agg(F.sum("nb_rows").alias("nb"), F.sum("in_block").alias("nb_prix"), spent)
    )
    return per_department(per_commune, read_table(spark, warehouse, "communes"))
