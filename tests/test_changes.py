"""Removal and upsert by marks: rows, files that stay, conflicts, compaction."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests.test_commits import communes, elsewhere

from toitscope.operators.changes import compact, merge_rows, remove_rows
from toitscope.operators.commits import CommitConflict, as_of, latest, transaction
from toitscope.operators.deliveries import new_sales
from toitscope.operators.marks import FILE, POSITION, bitmaps, unmarked
from toitscope.operators.storage import append, placed_rows, read_table, replace, staging, with_defaults
from toitscope.plans.loading import remove_communes

SALES = "transactions"


@pytest.fixture
def warehouse(tmp_path):
    return str(tmp_path / "warehouse")


def sales(spark, *rows):
    found = [(code, date(year, 5, 1), Decimal(price), "maison") for code, year, price in rows]
    kinds = "commune_id string, date_transaction date, prix decimal(12,2), type_bien string"
    return with_defaults(spark.createDataFrame(found, kinds), SALES)


def stored(spark, warehouse, **options):
    rows = read_table(spark, warehouse, SALES, **options).collect()
    return sorted((r["commune_id"], r["year"], int(r["prix"])) for r in rows)


def codes(spark, *found):
    return spark.createDataFrame([(c,) for c in found], "commune_id string")


def files(warehouse, table):
    return {str(p): p.stat().st_mtime_ns for p in Path(warehouse, table).rglob("*.parquet")}


def test_bitmaps_hide_exactly_the_rows_named(spark):
    size = 100_000
    rows = spark.range(1, size + 1).select(
        F.lit("f").alias(FILE), F.col("id").alias(POSITION), (F.col("id") * 7 % 11).alias("k")
    )
    edges = [1, 8, 9, 32767, 32768, 32769, 65536, 65537, size]
    gone = rows.where((F.col("k") == 3) | F.col(POSITION).isin(edges))
    marks = bitmaps(gone.unionAll(gone.limit(50)), []).unionAll(bitmaps(rows.where(F.col(POSITION) == 2), []))
    left = {r[0] for r in unmarked(rows, marks, []).select(POSITION).collect()}
    assert left == {n for n in range(1, size + 1) if n * 7 % 11 != 3 and n not in edges and n != 2}


def test_removed_rows_are_hidden_and_their_files_stay(spark, warehouse):
    append(sales(spark, ("01", 2022, 1), ("02", 2022, 2), ("02", 2023, 3), ("02", 2023, 3)), warehouse, SALES, "a")
    append(sales(spark, ("03", 2023, 4)), warehouse, SALES, "b")
    before = files(warehouse, SALES)
    remove_rows(spark, warehouse, SALES, codes(spark, "02", "02", None, "99"), "commune_id")
    assert stored(spark, warehouse) == [("01", 2022, 1), ("03", 2023, 4)]
    assert files(warehouse, SALES) == before
    assert len(stored(spark, warehouse, at=as_of(spark, warehouse, 2))) == 5
    # Only the folder that held such rows is read with marks.
    assert [sorted(on) for on in latest(spark, warehouse).marks(SALES).values()] == [
        [f for f in latest(spark, warehouse).folders(SALES) if f.endswith("load_id=a")]
    ]


def test_removals_add_up_and_compaction_keeps_load_ids(spark, warehouse):
    append(sales(spark, ("01", 2022, 1), ("02", 2022, 2), ("03", 2023, 3)), warehouse, SALES, "a")
    append(sales(spark, ("01", 2022, 5), ("04", 2023, 6)), warehouse, SALES, "b")
    append(sales(spark, ("05", 2023, 7)), warehouse, SALES, "c")
    remove_rows(spark, warehouse, SALES, codes(spark, "01"), "commune_id")
    remove_rows(spark, warehouse, SALES, codes(spark, "03"), "commune_id")
    want = [("02", 2022, 2), ("04", 2023, 6), ("05", 2023, 7)]
    assert stored(spark, warehouse) == want
    untouched = [f for f in latest(spark, warehouse).folders(SALES) if f.endswith("load_id=c")]
    assert len(compact(spark, warehouse, SALES)) == 2
    now = latest(spark, warehouse)
    assert stored(spark, warehouse) == want and not now.marks(SALES)
    assert sorted(f.rpartition("=")[2] for f in now.folders(SALES)) == ["a", "b", "c"]
    assert set(untouched) <= set(now.folders(SALES)) and compact(spark, warehouse, SALES) == []
    # Folders written by one compaction are told apart, also where their files have the same name.
    remove_rows(spark, warehouse, SALES, codes(spark, "02"), "commune_id")
    append(sales(spark, ("06", 2023, 8)), warehouse, SALES, "b")
    assert stored(spark, warehouse) == [("05", 2023, 7), ("06", 2023, 8)]


def test_removing_everything_or_nothing(spark, warehouse):
    remove_rows(spark, warehouse, SALES, codes(spark, "01"), "commune_id")
    assert latest(spark, warehouse).number == 0
    append(sales(spark, ("01", 2022, 1)), warehouse, SALES)
    remove_rows(spark, warehouse, SALES, codes(spark), "commune_id")
    remove_rows(spark, warehouse, SALES, codes(spark, "02"), "commune_id")
    assert latest(spark, warehouse).number == 1
    remove_rows(spark, warehouse, SALES, codes(spark, "01"), "commune_id")
    assert stored(spark, warehouse) == []
    compact(spark, warehouse, SALES)
    assert stored(spark, warehouse) == [] and latest(spark, warehouse).folders(SALES) == []


def test_removals_of_two_writers_both_hold(spark, warehouse):
    append(sales(spark, ("01", 2022, 1), ("02", 2022, 2), ("03", 2022, 3)), warehouse, SALES)
    with transaction(spark, warehouse):
        remove_rows(spark, warehouse, SALES, codes(spark, "01"), "commune_id")
        elsewhere(lambda: remove_rows(spark, warehouse, SALES, codes(spark, "02"), "commune_id"))
    assert stored(spark, warehouse) == [("03", 2022, 3)]


@pytest.mark.parametrize("rewrite", [compact, lambda s, w, t: replace(read_table(s, w, t).drop("year"), w, t)])
def test_a_removal_is_never_undone_by_a_rewrite(spark, warehouse, rewrite):
    append(sales(spark, ("01", 2022, 1), ("02", 2022, 2), ("03", 2022, 3)), warehouse, SALES)
    remove_rows(spark, warehouse, SALES, codes(spark, "03"), "commune_id")
    with pytest.raises(CommitConflict):
        with transaction(spark, warehouse):
            rewrite(spark, warehouse, SALES)
            elsewhere(lambda: remove_rows(spark, warehouse, SALES, codes(spark, "01"), "commune_id"))
    with pytest.raises(CommitConflict):
        with transaction(spark, warehouse):
            remove_rows(spark, warehouse, SALES, codes(spark, "02"), "commune_id")
            elsewhere(lambda: rewrite(spark, warehouse, SALES))
    assert stored(spark, warehouse) == [("02", 2022, 2)]


def test_merge_writes_what_it_changes(spark, warehouse):
    append(communes(spark, "06001", "06002", "06003"), warehouse, "communes")
    before = files(warehouse, "communes")
    given = communes(spark, "06002", "06009").withColumn("nom", F.lit("new"))
    merge_rows(given, warehouse, "communes", ["nom", "dept", "region"])
    rows = {r["code_insee"]: r["nom"] for r in read_table(spark, warehouse, "communes").collect()}
    assert rows == {"06001": "n", "06002": "new", "06003": "n", "06009": "new"}
    after = files(warehouse, "communes")
    assert before.items() <= after.items()
    added = spark.read.parquet(*sorted(set(after) - set(before)))
    assert sorted(r["code_insee"] for r in added.collect()) == ["06002", "06009"]
    merge_rows(given.withColumn("nom", F.lit("newer")), warehouse, "communes", ["nom"])
    compact(spark, warehouse, "communes")
    rows = {r["code_insee"]: r["nom"] for r in read_table(spark, warehouse, "communes").collect()}
    assert rows == {"06001": "n", "06002": "newer", "06003": "n", "06009": "newer"}


def test_two_merges_conflict(spark, warehouse):
    append(communes(spark, "06001"), warehouse, "communes")
    with pytest.raises(CommitConflict):
        with transaction(spark, warehouse):
            merge_rows(communes(spark, "06002"), warehouse, "communes", ["nom"])
            elsewhere(lambda: merge_rows(communes(spark, "06002"), warehouse, "communes", ["nom"]))
    assert read_table(spark, warehouse, "communes").count() == 2


def test_cascade_writes_marks_only(spark, warehouse):
    append(communes(spark, "06001", "06002"), warehouse, "communes")
    append(sales(spark, ("06001", 2022, 1), ("06002", 2022, 2)), warehouse, SALES)
    before = files(warehouse, SALES) | files(warehouse, "communes")
    remove_communes(spark, warehouse, spark.createDataFrame([("06001",)], "code_insee string"))
    assert stored(spark, warehouse) == [("06002", 2022, 2)]
    assert [r["code_insee"] for r in read_table(spark, warehouse, "communes").collect()] == ["06002"]
    assert files(warehouse, SALES) | files(warehouse, "communes") == before


def test_removed_sales_can_be_delivered_again(spark, warehouse):
    given = sales(spark, ("01", 2022, 1), ("02", 2022, 2))
    append(given, warehouse, SALES, "a")

    def again(load):
        with staging(spark), transaction(spark, warehouse):
            fresh = new_sales(given, warehouse, load)
            append(with_defaults(fresh, SALES), warehouse, SALES, load)

    again("b")
    assert stored(spark, warehouse) == [("01", 2022, 1), ("02", 2022, 2)]
    remove_rows(spark, warehouse, SALES, codes(spark, "01"), "commune_id")
    again("c")
    assert stored(spark, warehouse) == [("01", 2022, 1), ("02", 2022, 2)]


def test_filters_reach_the_scan_beside_marks(spark, warehouse):
    append(sales(spark, ("01", 2022, 1), ("02", 2023, 2)), warehouse, SALES)
    remove_rows(spark, warehouse, SALES, codes(spark, "01"), "commune_id")
    at = latest(spark, warehouse)
    rows = placed_rows(spark, warehouse, SALES, at.folders(SALES), at).where("commune_id = '02' AND year = 2023")
    plan = rows.select("prix")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(commune_id,02)" in plan and "year#" in plan and "adresse" not in plan
