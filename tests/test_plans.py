"""Physical plans: one scan, filters in the scan, no Python, nothing joined before it is reduced."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from toitscope.operators import integrity, keyed, ledger, ranking
from toitscope.plans import areas, energy, prices

SALES = (
    "commune_id string, date_transaction date, prix decimal(12,2), surface decimal(10,2), prix_m2 decimal(10,2), "
    "type_bien string"
)
REGISTER = "code_insee string, nom string, dept string, region string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    sales = spark.range(2_000).select(
        (F.col("id") % 13).cast("string").alias("commune_id"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 300).cast("int")).alias("date_transaction"),
        (F.col("id") * 101).cast("decimal(12,2)").alias("prix"),
        (F.col("id") % 90).cast("decimal(10,2)").alias("surface"),
        (F.col("id") * 3).cast("decimal(10,2)").alias("prix_m2"),
        F.lit("maison").alias("type_bien"),
    )
    sales.write.parquet(f"{root}/sales")
    register = spark.range(13).select(
        F.col("id").cast("string").alias("code_insee"),
        F.concat(F.lit("c"), "id").alias("nom"),
        (F.col("id") % 4).cast("string").alias("dept"),
        (F.col("id") % 2).cast("string").alias("region"),
    )
    register.write.parquet(f"{root}/communes")
    return spark.read.schema(SALES).parquet(f"{root}/sales"), spark.read.schema(REGISTER).parquet(f"{root}/communes")


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final(text: str) -> str:
    """The part of an adaptive plan that ran."""
    return text.split("== Initial Plan ==")[0]


def test_price_stats_plan(tables):
    sales, communes = tables
    text = final(plan(prices.price_stats(sales, communes, F.lit(dt.date(2023, 12, 1)))))
    assert "GreaterThanOrEqual(date_transaction,2022-12-01)" in text
    # The counts of the amounts are shuffled once and read twice.
    assert text.count("Generate inline") == 1
    assert "ReusedExchange" in text
    assert "type_bien" not in text
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_levels_read_the_sales_once(tables):
    sales, communes = tables
    text = final(plan(areas.stats_by_level(sales, communes)))
    scans = text.split("Generate inline(array(struct(measure")
    assert len(scans) == 2 and "ReusedExchange" in text
    assert "Python" not in text and "NestedLoop" not in text


@pytest.mark.parametrize(
    ("build", "rows_per_sale"),
    [
        (lambda sales, communes: areas.yearly_prices(sales, communes), 1),
        (lambda sales, communes: areas.area_against_parent(sales, communes), 1),
        (lambda sales, communes: areas.stats_by_level(sales, communes), 2),
        (lambda sales, communes: prices.price_stats(sales, communes, F.lit(dt.date(2023, 12, 1))), 2),
    ],
)
def test_a_sale_becomes_one_row_per_measure_that_is_read(tables, build, rows_per_sale):
    text = build(*tables)._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in text.split("\n") if "Generate inline(array(struct(measure" in line]
    assert made and all(line.count("struct(measure") == rows_per_sale for line in made)


def test_plans_are_lazy(tables, spark):
    """Building an analysis starts no job."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        areas.area_against_parent(*tables)
        areas.stats_by_level(*tables)
        areas.yearly_prices(*tables)
        assert not tracker.getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_energy_is_reduced_before_the_join(tables, spark):
    _, communes = tables
    dpe = tables[0].select(
        "commune_id",
        F.lit("A").alias("classe_energetique"),
        F.col("surface").alias("consommation_energie"),
        F.col("surface").alias("emissions_co2"),
    )
    text = energy.energy_stats(dpe, communes)._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Join Inner") < text.index("Aggregate [commune_id")


def test_ranking_limits_rows_before_the_shuffle(tables):
    sales, _ = tables
    text = final(plan(ranking.first_n_per_group(sales, ["commune_id"], [F.col("prix")], 3)))
    assert "WindowGroupLimit" in text


def test_top_k_needs_no_full_sort(tables):
    sales, communes = tables
    text = final(plan(prices.busiest_departments(sales, communes, 3)))
    assert "TakeOrderedAndProject" in text


def test_latest_run_combines_before_the_shuffle(spark):
    schema = (
        "id string, scraper_name string, started_at timestamp_ntz, completed_at timestamp_ntz, status string, "
        "records_processed bigint"
    )
    text = final(plan(ledger.latest_runs(spark.createDataFrame([], schema))))
    assert "Window" not in text and text.count("max_by") >= 2


def test_foreign_key_check_is_a_semi_join(tables):
    sales, communes = tables
    text = plan(integrity.loadable(sales, communes, "commune_id", "code_insee"))
    assert "LeftSemi" in text and "Broadcast" in text


def test_multiset_difference_ships_counts(tables):
    sales, _ = tables
    text = keyed.not_yet_loaded(sales, sales.limit(5), sales.columns)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(_sign" in text
