"""Kept counts: the same figures as from the stored sales, after loads, removals, compaction, and by any first day."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tests.test_commits import communes, elsewhere
from tests.test_loading import landing, sale  # noqa: F401

from toitscope.operators import kept
from toitscope.operators.changes import compact, remove_rows
from toitscope.operators.commits import CommitConflict, current, in_transaction, latest, transaction
from toitscope.operators.kept import BLOCKS, COUNTS, PRICES, covered, read_amounts, read_sums, refresh_counts
from toitscope.operators.medians import amount_counts, block_sums
from toitscope.operators.storage import append, read_table, replace, with_defaults
from toitscope.plans.areas import stats_by_level, yearly_prices
from toitscope.plans.kept_prices import (
    kept_department_prices,
    kept_price_stats,
    kept_stats_by_level,
    kept_yearly_prices,
)
from toitscope.plans.loading import load_communes, load_transactions, remove_communes
from toitscope.plans.prices import department_prices, price_stats
from toitscope.plans.views import open_warehouse
from toitscope.schemas import TRANSACTION_COLUMNS
from toitscope.streaming.incremental import ingest_transactions

SALES = "transactions"
CODES = ["01001", "01002", "02001", "03001"]


@pytest.fixture
def warehouse(tmp_path):
    return str(tmp_path / "warehouse")


def some_sales(spark, seed, number=60, last=date(2024, 3, 1), days=1200):
    draw = random.Random(seed)
    rows = [
        (
            draw.choice(CODES),
            last - timedelta(days=draw.randrange(days)),
            Decimal(draw.randrange(5)) * 1000 + Decimal("0.10"),
            draw.choice([None, Decimal(20), Decimal("35.50")]),
            draw.choice([None, Decimal("1500.25"), Decimal(2000)]),
            "maison",
        )
        for _ in range(number)
    ]
    kinds = "commune_id string, date_transaction date, prix decimal(12,2), surface decimal(10,2), prix_m2 decimal(10,2), type_bien string"
    return with_defaults(spark.createDataFrame(rows, kinds), SALES)


def codes(spark, *found):
    return spark.createDataFrame([(c,) for c in found], "commune_id string")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def same_figures(spark, warehouse, as_of=date(2024, 2, 29)):
    sales, register = read_table(spark, warehouse, SALES), read_table(spark, warehouse, "communes")
    day = F.lit(as_of)
    assert rows(kept_price_stats(spark, warehouse, day)) == rows(price_stats(sales, register, day))
    assert rows(kept_stats_by_level(spark, warehouse)) == rows(stats_by_level(sales, register))


def all_counted(spark, warehouse):
    at = latest(spark, warehouse)
    used, unused, missing = covered(at)
    return bool(used) and not unused and not missing


def test_figures_follow_loads_removals_and_rewrites(spark, warehouse):
    append(communes(spark, *CODES), warehouse, "communes")
    for load in ("a", "b", "c"):
        append(some_sales(spark, load), warehouse, SALES, load)
        assert len(refresh_counts(spark, warehouse)) == 1
    assert all_counted(spark, warehouse) and refresh_counts(spark, warehouse) == []
    same_figures(spark, warehouse)
    gone = codes(spark, "01002", "02001").withColumnRenamed("commune_id", "code_insee")
    remove_communes(spark, warehouse, gone)
    assert all_counted(spark, warehouse)
    same_figures(spark, warehouse)
    assert {r[0] for r in read_sums(spark, warehouse, ["commune_id"]).select("commune_id").collect()} == {"01001", "03001"}
    compact(spark, warehouse, SALES)
    assert all_counted(spark, warehouse)
    same_figures(spark, warehouse)
    # A load repeated under its id takes its counts along, and one that is not counted yet is read from its rows.
    append(some_sales(spark, "other"), warehouse, SALES, "b")
    same_figures(spark, warehouse)
    refresh_counts(spark, warehouse)
    assert all_counted(spark, warehouse)
    replace(read_table(spark, warehouse, SALES).drop("year"), warehouse, SALES)
    same_figures(spark, warehouse)


def test_other_figures_and_the_view(spark, warehouse):
    append(communes(spark, *CODES[:3]), warehouse, "communes")
    append(some_sales(spark, 1), warehouse, SALES, "a")
    register, sales = read_table(spark, warehouse, "communes"), read_table(spark, warehouse, SALES)
    before = rows(open_warehouse(spark, warehouse)["v_prix_median_communes"])
    refresh_counts(spark, warehouse)
    view = open_warehouse(spark, warehouse)["v_prix_median_communes"]
    assert any(COUNTS in name for name in view.inputFiles()) and rows(view) == before
    assert rows(kept_department_prices(spark, warehouse)) == rows(department_prices(sales, register))
    assert rows(kept_yearly_prices(spark, warehouse)) == rows(yearly_prices(sales, register))


def test_stored_sales_are_not_read(spark, warehouse):
    append(communes(spark, *CODES), warehouse, "communes")
    append(some_sales(spark, 2), warehouse, SALES, "a")
    refresh_counts(spark, warehouse)
    for df in (kept_price_stats(spark, warehouse), kept_stats_by_level(spark, warehouse)):
        assert not [name for name in df.inputFiles() if f"/{SALES}/" in name]


@pytest.mark.parametrize("first", ["2023-01-01", "2023-02-28", "2024-02-29", "2023-12-01", "2023-12-31", "2022-11-30", "2030-01-01"])
def test_a_period_is_its_days_and_years(spark, warehouse, first):
    append(some_sales(spark, first, 200), warehouse, SALES, "a")
    refresh_counts(spark, warehouse)
    since = F.lit(first).cast("date")
    sales = read_table(spark, warehouse, SALES).where(F.col("date_transaction") >= since)
    for keys in (["commune_id"], ["commune_id", "year"]):
        want = amount_counts(sales, keys, list(BLOCKS))
        got = read_amounts(spark, warehouse, keys, since=since)
        got = got.groupBy(*keys, "measure", "units").agg(F.sum("n").alias("n"))
        assert rows(got) == rows(want.where(F.col("measure") < len(PRICES)))
        assert rows(read_sums(spark, warehouse, keys, since=since)) == rows(block_sums(want, keys, BLOCKS))


def test_rows_removed_before_they_are_counted_are_not_taken_away_twice(spark, warehouse):
    append(communes(spark, *CODES), warehouse, "communes")
    append(some_sales(spark, 3), warehouse, SALES, "a")
    refresh_counts(spark, warehouse)
    append(some_sales(spark, 4), warehouse, SALES, "b")
    remove_rows(spark, warehouse, SALES, codes(spark, "01001"), "commune_id")
    same_figures(spark, warehouse)
    refresh_counts(spark, warehouse)
    same_figures(spark, warehouse)
    remove_rows(spark, warehouse, SALES, codes(spark, "01001", "01002"), "commune_id")
    same_figures(spark, warehouse)
    remove_rows(spark, warehouse, SALES, codes(spark, *CODES), "commune_id")
    assert rows(kept_stats_by_level(spark, warehouse)) == []
    compact(spark, warehouse, SALES)
    assert rows(kept_stats_by_level(spark, warehouse)) == []


def test_two_writers_that_remove_the_same_rows(spark, warehouse):
    append(communes(spark, *CODES), warehouse, "communes")
    append(some_sales(spark, 5), warehouse, SALES, "a")
    refresh_counts(spark, warehouse)
    with pytest.raises(CommitConflict):
        with transaction(spark, warehouse):
            remove_rows(spark, warehouse, SALES, codes(spark, "01001"), "commune_id")
            elsewhere(lambda: remove_rows(spark, warehouse, SALES, codes(spark, "01001", "02001"), "commune_id"))
    in_transaction(spark, warehouse, lambda: remove_rows(spark, warehouse, SALES, codes(spark, "01001"), "commune_id"))
    same_figures(spark, warehouse)


def test_a_refresh_beside_an_append_is_done_anew(spark, warehouse):
    append(communes(spark, *CODES), warehouse, "communes")
    append(some_sales(spark, 6), warehouse, SALES, "a")
    with pytest.raises(CommitConflict):
        with transaction(spark, warehouse):
            refresh_counts(spark, warehouse)
            elsewhere(lambda: append(some_sales(spark, 7), warehouse, SALES, "b"))
    assert not current(spark, warehouse).folders(COUNTS)
    assert len(refresh_counts(spark, warehouse)) == 2
    same_figures(spark, warehouse)


def test_an_empty_warehouse_and_an_empty_load(spark, warehouse):
    assert refresh_counts(spark, warehouse) == []
    assert rows(kept_stats_by_level(spark, warehouse)) == [] == rows(kept_price_stats(spark, warehouse))
    append(communes(spark, *CODES), warehouse, "communes")
    append(some_sales(spark, 8).limit(0), warehouse, SALES, "a: b")
    refresh_counts(spark, warehouse)
    assert all_counted(spark, warehouse) and rows(kept_stats_by_level(spark, warehouse)) == []
    append(some_sales(spark, 8), warehouse, SALES, "a: b")
    refresh_counts(spark, warehouse)
    assert all_counted(spark, warehouse)
    same_figures(spark, warehouse)


def test_loads_and_streams_keep_the_counts_once_there_are_any(spark, landing, warehouse, write, tmp_path):  # noqa: F811
    load_communes(spark, landing, warehouse)
    load_transactions(spark, landing, warehouse, [2022])
    assert not latest(spark, warehouse).folders(COUNTS)
    refresh_counts(spark, warehouse)
    load_transactions(spark, landing, warehouse, [2023], load_id="second")
    assert all_counted(spark, warehouse)
    load_transactions(spark, landing, warehouse, [2023], load_id="second")
    assert all_counted(spark, warehouse)
    drops = write("drops", "a.csv", "|".join(TRANSACTION_COLUMNS), sale("75056", "2023-12-31", "300000"))
    ingest_transactions(spark, drops, warehouse, str(tmp_path / "checkpoint"))
    assert all_counted(spark, warehouse)
    same_figures(spark, warehouse, date(2024, 5, 1))
    levels = {r["level"]: r["nb_transactions"] for r in kept_stats_by_level(spark, warehouse).collect() if r["level"] == "national"}
    assert levels == {"national": 6}


def odd_sales(spark, load):
    """Sales of different amounts, large, negative and unknown ones among them; some without a commune or a day."""
    rows = [
        (
            None if i % 7 == 0 else CODES[i % 4],
            None if i % 11 == 0 else date(2021 + i % 3, 1 + i % 12, 1 + i % 28),
            {0: None, 1: Decimal("9999999999.99"), 2: Decimal("-12345.67")}.get(i % 13, Decimal(i * 997) + Decimal("0.37")),
            None if i % 5 == 0 else Decimal("99999999.99") - i,
            None if i % 6 == 0 else Decimal(i * 31),
            f"{load}-{i % 2}" if i % 3 else "loft",
        )
        for i in range(120)
    ]
    kinds = "commune_id string, date_transaction date, prix decimal(12,2), surface decimal(10,2), prix_m2 decimal(10,2), type_bien string"
    return with_defaults(spark.createDataFrame(rows, kinds), SALES)


def same_counts(spark, warehouse):
    sales = read_table(spark, warehouse, SALES)
    for keys in (["commune_id"], ["commune_id", "year"]):
        want = amount_counts(sales, keys, list(BLOCKS))
        got = read_amounts(spark, warehouse, keys).groupBy(*keys, "measure", "units").agg(F.sum("n").alias("n")).where("n <> 0")
        assert rows(got) == rows(want.where(F.col("measure") < len(PRICES)))
        figures = [F.coalesce("total", F.lit(0)).alias("total"), *[c for c in (*keys, "measure", "block", "nb_rows", "in_block")]]
        assert rows(read_sums(spark, warehouse, keys).select(*figures)) == rows(block_sums(want, keys, BLOCKS).select(*figures))


def test_a_sale_has_a_row_of_counts_at_most(spark, warehouse):
    """The measures of a sale are counted, shuffled and stored together, not in a row for each."""
    append(odd_sales(spark, "a"), warehouse, SALES, "a")
    refresh_counts(spark, warehouse)
    append(odd_sales(spark, "b"), warehouse, SALES, "b")
    refresh_counts(spark, warehouse)
    stored = spark.read.parquet(f"{warehouse}/{COUNTS}")
    assert stored.where(F.col("grain") == "day").count() == 240
    same_counts(spark, warehouse)
    append(odd_sales(spark, "c"), warehouse, SALES, "c")
    same_counts(spark, warehouse)


def test_a_compaction_adds_up_only_what_was_touched(spark, warehouse, monkeypatch):
    for load in ("a", "b"):
        append(odd_sales(spark, load).where(F.col("date_transaction").isNotNull()), warehouse, SALES, load)
        refresh_counts(spark, warehouse)
    remove_rows(spark, warehouse, SALES, codes(spark, "01002"), "commune_id")
    added = []
    sums = kept._sums
    monkeypatch.setattr(kept, "_sums", lambda found, *a: added.append({r[0] for r in found.select("commune_id").distinct().collect()}) or sums(found, *a))
    compact(spark, warehouse, SALES)
    monkeypatch.undo()
    assert added and all(communes == {"01002"} for communes in added)
    assert all_counted(spark, warehouse)
    same_counts(spark, warehouse)
    # Communes that are not known are touched like any other.
    remove_rows(spark, warehouse, SALES, spark.createDataFrame([("loft",)], "type_bien string"), "type_bien")
    same_counts(spark, warehouse)
    compact(spark, warehouse, SALES)
    assert all_counted(spark, warehouse)
    same_counts(spark, warehouse)
    used, _, _ = covered(latest(spark, warehouse))
    assert kept._read(spark, warehouse, used, "day").where("n <= 0").count() == 0
