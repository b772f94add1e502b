"""Prices at national, regional, departmental and commune level, over time and against each other.

Medians of a wider area are found from its sales, never from the medians of its parts. The sales are read once
and reduced to amount counts per commune; everything wider is added up from those counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from toitscope.plans.prices import sale_stats

AREA = ["region", "dept", "commune_id"]
# Area columns that name an area at each level, widest first.
LEVELS = {"national": AREA[:0], "region": AREA[:1], "dept": AREA[:2], "commune": AREA}


def area_members(communes: DataFrame) -> DataFrame:
    """Each commune under its commune, department, region and the country.

    An area column that does not apply to a level is blank.
    """
    own = {"region": F.col("region"), "dept": F.col("dept"), "commune_id": F.col("code_insee")}

    def entry(level: str) -> Column:
        parts = [
            F.coalesce(own[name] if name in LEVELS[level] else F.lit(""), F.lit("")).alias(f"area_{name}")
            for name in AREA
        ]
        return F.struct(F.lit(level).alias("level"), *parts)

    entries = F.array(*[entry(level) for level in LEVELS])
    return communes.select(F.col("code_insee").alias("commune_id"), F.inline(entries))


def stats_by_level(transactions: DataFrame, communes: DataFrame) -> DataFrame:
    """Count, median and mean prices and mean surface of the country, each region, department, commune."""
    members = area_members(communes)
    return by_level(sale_stats(transactions, ["commune_id"], ["prix", "prix_m2"], members, mean_surface=True))


def by_level(stats: DataFrame) -> DataFrame:
    """Figures of areas with the area columns that apply to their level."""

    def applies(name: str) -> Column:
        return F.col("level").isin([level for level, names in LEVELS.items() if name in names])

    return stats.select(
        "level",
        *[F.when(applies(name), F.col(f"area_{name}")).alias(name) for name in AREA],
        *[name for name in stats.columns if name != "level" and not name.startswith("area_")],
    )


def yearly_prices(transactions: DataFrame, communes: DataFrame, area: str = "dept") -> DataFrame:
    """Yearly median price per area and its change against the year before, absolute and in percent.

    ``area`` is a column of the register. The change is NULL when the area has no sale in the year before.
    """
    dated = transactions.withColumn("annee", F.year("date_transaction"))
    return year_on_year(sale_stats(dated, ["commune_id", "annee"], ["prix"], one_area(communes, area)))


def one_area(communes: DataFrame, area: str) -> DataFrame:
    """Each commune under one column of the register."""
    return communes.select(F.col("code_insee").alias("commune_id"), F.coalesce(area, F.lit("")).alias("area"))


def year_on_year(yearly: DataFrame) -> DataFrame:
    """Yearly figures of areas with the change against the year before."""
    by_year = W.partitionBy("area").orderBy("annee")
    adjacent = F.lag("annee").over(by_year) == F.col("annee") - 1
    change = F.col("prix_median") - F.col("prix_median_before")
    return yearly.withColumn("prix_median_before", F.when(adjacent, F.lag("prix_median").over(by_year))).select(
        "area",
        "annee",
        "nb_transactions",
        "prix_median",
        "prix_median_before",
        F.round(change, 3).alias("change"),
        F.round(F.try_divide(100 * change, F.col("prix_median_before")), 4).alias("change_pct"),
    )


def area_against_parent(transactions: DataFrame, communes: DataFrame) -> DataFrame:
    """Commune median against its department's and the country's, and its rank within the department.

    ``rank_pct`` is 0 for the cheapest commune of a department and 1 for the dearest.
    """
    medians = by_level(sale_stats(transactions, ["commune_id"], ["prix"], area_members(communes)))
    national = medians.where(F.col("level") == "national").select("prix_median")
    local = medians.where(F.col("level").isin("dept", "commune"))
    # A department and its communes meet in one window; both share the region and department columns.
    within = W.partitionBy("region", "dept")
    placed = local.withColumn("dept_median", F.max(F.when(F.col("level") == "dept", F.col("prix_median"))).over(within))
    rank = F.percent_rank().over(W.partitionBy("region", "dept", "level").orderBy("prix_median"))
    return (
        placed.withColumn("rank_pct", rank)
        .where(F.col("level") == "commune")
        .withColumn("national_median", national.scalar())
        .select(
            "commune_id",
            "dept",
            "prix_median",
            "dept_median",
            "national_median",
            F.round(F.try_divide("prix_median", "dept_median"), 6).alias("ratio_dept"),
            F.round(F.try_divide("prix_median", "national_median"), 6).alias("ratio_national"),
            "rank_pct",
        )
    )
