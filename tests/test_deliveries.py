"""Deliveries that repeat stored sales, by batch and by stream."""

from __future__ import annotations

import pytest

from toitscope.operators.commits import latest, transaction
from toitscope.operators.deliveries import INDEX, index_sales, new_sales, reached, read_index
from toitscope.operators.storage import read_table, replace
from toitscope.plans import loading
from toitscope.schemas import TRANSACTION_COLUMNS
from toitscope.streaming.incremental import ingest_transactions

HEADER = "|".join(TRANSACTION_COLUMNS)


def sale(code: str, day: str, price: str) -> str:
    return f"{code}|{day}|{price}|Maison|50|3|Vente|1|RUE X|{code}"


A, B, C = sale("06088", "2023-05-01", "1"), sale("06088", "2023-06-01", "2"), sale("75056", "2022-06-01", "3")


@pytest.fixture
def warehouse(spark, write, tmp_path):
    write("in/communes", "a.csv", "com_code,com_nom,dep_code,reg_nom,latitude,longitude", "06088,Nice,06,PACA,,", "75056,Paris,75,IDF,,")
    loading.load_communes(spark, str(tmp_path / "in"), str(tmp_path / "warehouse"))
    return str(tmp_path / "warehouse")


def prices(spark, warehouse):
    return sorted(int(r["prix"]) for r in read_table(spark, warehouse, "transactions").collect())


def test_a_delivery_streamed_from_two_folders_is_stored_once(spark, write, tmp_path, warehouse):
    def run(folder, *rows):
        write(f"drops/{folder}", "a.csv", HEADER, *rows)
        ingest_transactions(spark, str(tmp_path / "drops"), warehouse, str(tmp_path / "checkpoint"), only_new=True)
        return prices(spark, warehouse)

    assert run("2023-07-01", A, A, B) == [1, 1, 2]
    assert run("2023-08-01", A, A, B) == [1, 1, 2]
    assert run("2023-09-01", A, A, A, C, C) == [1, 1, 1, 2, 3, 3]
    # One index for each load folder, also of loads that brought nothing.
    now = latest(spark, warehouse)
    assert {f.rpartition("/")[0] for f in now.folders(INDEX)} <= set(now.folders("transactions"))


def test_a_load_done_again_under_its_id_does_not_meet_itself(spark, write, tmp_path, warehouse):
    root = str(tmp_path / "in")
    write("in/transactions/year=2023/dept=06", "a.csv", HEADER, A, A, B)
    for _ in range(2):
        assert loading.load_transactions(spark, root, warehouse, only_new=True, load_id="one").rows_written == 3
    assert loading.load_transactions(spark, root, warehouse, only_new=True).rows_written == 0
    assert prices(spark, warehouse) == [1, 1, 2]


def test_removed_sales_can_be_delivered_again(spark, write, tmp_path, warehouse):
    root = str(tmp_path / "in")
    write("in/transactions/year=2023/dept=06", "a.csv", HEADER, A, C)
    loading.load_transactions(spark, root, warehouse, only_new=True)
    loading.load_transactions(spark, root, warehouse, only_new=True)
    with transaction(spark, warehouse):
        rest = read_table(spark, warehouse, "transactions").where("prix = 3")
        replace(rest.drop("year"), warehouse, "transactions")
    loading.load_transactions(spark, root, warehouse, only_new=True)
    assert prices(spark, warehouse) == [1, 3]


def test_only_the_reached_part_of_the_index_is_read(spark, write, tmp_path, warehouse):
    root = str(tmp_path / "in")
    write("in/transactions/year=2023/dept=06", "a.csv", HEADER, A, B, C)
    loading.load_transactions(spark, root, warehouse)
    with transaction(spark, warehouse):
        index = read_index(spark, warehouse, list(index_sales(spark, warehouse).values()))
        batch = read_table(spark, warehouse, "transactions").where("prix = 3")
        plan = reached(index, batch)._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan and "GreaterThanOrEqual(commune_id" in plan
        assert reached(index, batch).count() == 1
        assert reached(index, batch.where("false")).count() == 0
        # The comparison takes nothing from the stored rows themselves.
        files = new_sales(batch.drop("year", "created_at"), warehouse, "other").inputFiles()
        assert any(f"/{INDEX}/" in f for f in files)


def test_a_hot_sale_is_dealt_out(spark, write, tmp_path, warehouse):
    write("in/transactions/year=2023/dept=06", "a.csv", HEADER, *[A] * 500)
    loading.load_transactions(spark, str(tmp_path / "in"), warehouse, only_new=True)
    write("in/transactions/year=2023/dept=06", "a.csv", HEADER, *[A] * 1200)
    assert loading.load_transactions(spark, str(tmp_path / "in"), warehouse, only_new=True).rows_written == 700
    assert len(prices(spark, warehouse)) == 1200
