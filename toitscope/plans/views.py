"""Tables and analytic views under their stored names, for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from toitscope.operators.commits import current
from toitscope.operators.kept import keeps_counts
from toitscope.operators.ledger import fold_runs, latest_runs, read_events
from toitscope.operators.storage import read_table
from toitscope.plans.energy import energy_stats
from toitscope.plans.kept_prices import kept_price_stats
from toitscope.plans.prices import price_stats

TABLE_NAMES = ["communes", "transactions", "demographics", "dpe", "infrastructure"]
EVENTS_FOLDER = "scraping_events"


def open_warehouse(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """Every table and view by name; nothing is computed until one is used.

    The price view reads the kept counts where there are any.
    """
    tables = {name: read_table(spark, warehouse, name) for name in TABLE_NAMES}
    runs = fold_runs(read_events(spark, f"{warehouse}/{EVENTS_FOLDER}"))
    if keeps_counts(current(spark, warehouse)):
        prices = kept_price_stats(spark, warehouse)
    else:
        prices = price_stats(tables["transactions"], tables["communes"])
    return {
        **tables,
        "scraping_history": runs,
        "v_prix_median_communes": prices,
        "v_dpe_stats_communes": energy_stats(tables["dpe"], tables["communes"]),
        "v_last_scraping_runs": latest_runs(runs),
    }


def register_views(spark: SparkSession, warehouse: str) -> list[str]:
    """Make every table and view visible to ``spark.sql`` under its name."""
    found = open_warehouse(spark, warehouse)
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return sorted(found)
