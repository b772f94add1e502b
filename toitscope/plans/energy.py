"""Energy-diagnosis statistics per commune."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toitscope.functions.measures import share_pct
from toitscope.schemas import BAD_CLASSES, GOOD_CLASSES


def energy_stats(dpe: DataFrame, communes: DataFrame) -> DataFrame:
    """Diagnoses, good (A-C) and bad (F-G) ones, share of good, mean consumption and emissions.

    Diagnoses are reduced to one row per commune before they meet the register.
    """
    good = F.count_if(F.col("classe_energetique").isin(GOOD_CLASSES))
    bad = F.count_if(F.col("classe_energetique").isin(BAD_CLASSES))
    figures = dpe.groupBy("commune_id").agg(
        F.count("*").alias("nb_dpe"),
        good.alias("nb_bonne_perf"),
        bad.alias("nb_mauvaise_perf"),
        F.avg("consommation_energie").alias("conso_energie_moyenne"),
        F.avg("emissions_co2").alias("emissions_co2_moyenne"),
    )
    register = communes.select(F.col("code_insee").alias("commune_id"), F.col("nom").alias("commune_nom"))
    return figures.join(register, "commune_id").select(
        "commune_id",
        "commune_nom",
        "nb_dpe",
        "nb_bonne_perf",
        "nb_mauvaise_perf",
        share_pct(F.col("nb_bonne_perf"), F.col("nb_dpe")).alias("pct_bonne_perf"),
        "conso_energie_moyenne",
        "emissions_co2_moyenne",
    )
