"""The load end to end: files in, tables, quarantine, ledger and views out."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from toitscope.operators.keyed import KeyConflict
from toitscope.operators.ledger import fold_runs, read_events
from toitscope.operators.storage import read_table
from toitscope.plans import loading
from toitscope.plans.views import EVENTS_FOLDER, register_views
from toitscope.schemas import DPE_COLUMNS, TABLES, TRANSACTION_COLUMNS, TRANSACTIONS_SOURCE
from toitscope.operators.cleaning import clean_transactions
from toitscope.streaming.incremental import ingest_delimited, ingest_transactions

COMMUNE_HEADER = "com_code,com_nom,dep_code,reg_nom,latitude,longitude"


def sale(code: str, day: str, price: str, surface: str = "50") -> str:
    return f"{code}|{day}|{price}|Maison|{surface}|3|Vente|1|RUE X|{code}"


def diagnosis(code: str, label: str) -> str:
    return f"{code},{label},B,100,20,Maison,1990,80,2023-03-01"


@pytest.fixture
def landing(write, tmp_path):
    write("in/communes", "a.csv", COMMUNE_HEADER, "06088,Nice,06,PACA,43.7,7.2", "75056,Paris,75,IDF,48.8,2.3")
    header = "|".join(TRANSACTION_COLUMNS)
    write(
        "in/transactions/year=2023/dept=06",
        "a.csv",
        header,
        sale("06088", "2023-05-01", "100000"),
        sale("06088", "2023-06-01", "200000"),
        sale("06088", "2023-06-01", "200000"),
        sale("06999", "2023-06-01", "1"),
        sale("06088", "2023-06-01", "x"),
        sale("06088", "2023-06-01", "99999999999"),
    )
    write("in/transactions/year=2023/dept=75", "a.csv", header, sale("75056", "2023-07-01", "500000", ""))
    write("in/transactions/year=2022/dept=75", "a.csv", header, sale("75056", "2022-07-01", "400000"))
    write("in/population", "a.csv", "COM;PMUN", "06088;340000", "75056;2100000", "99999;1")
    write("in/income", "a.csv", "CODGEO;MED21", "06088;20000", "75056;28000.5")
    dpe = ",".join(DPE_COLUMNS)
    write("in/dpe/dept=06", "a.csv", dpe, *[diagnosis("06088", label) for label in "ABFH"])
    write("in/dpe/dept=75", "a.csv", dpe, diagnosis("75056", "C"))
    return str(tmp_path / "in")


@pytest.fixture
def warehouse(tmp_path):
    return str(tmp_path / "warehouse")


def test_load_all(spark, landing, warehouse):
    done = loading.load_all(spark, landing, warehouse, 2023)
    assert done == {"communes": True, "transactions": True, "demographics": True, "dpe": True}
    for name in ("communes", "transactions", "demographics", "dpe"):
        kinds = dict(read_table(spark, warehouse, name).dtypes)
        assert {f.name: f.dataType.simpleString() for f in TABLES[name].fields}.items() <= kinds.items()
    tx = read_table(spark, warehouse, "transactions")
    assert sorted((r["commune_id"], r["prix"], r["prix_m2"], r["year"]) for r in tx.collect()) == [
        ("06088", Decimal("100000.00"), Decimal("2000.00"), 2023),
        ("06088", Decimal("200000.00"), Decimal("4000.00"), 2023),
        ("06088", Decimal("200000.00"), Decimal("4000.00"), 2023),
        ("75056", Decimal("500000.00"), None, 2023),
    ]
    assert tx.where("created_at IS NULL").count() == 0
    bad = loading.read_quarantine(spark, warehouse).collect()
    reasons = sorted((r["table_name"], tuple(r["violations"])) for r in bad)
    assert reasons == [
        ("demographics", ("commune_unknown",)),
        ("dpe", ("unknown_label",)),
        ("transactions", ("commune_unknown",)),
        ("transactions", ("prix_range", "prix_m2_range")),
        ("transactions", ("unreadable_value",)),
    ]
    runs = {r["scraper_name"]: r for r in fold_runs(read_events(spark, f"{warehouse}/{EVENTS_FOLDER}")).collect()}
    assert {name: (r["status"], r["records_processed"], r["table_total"]) for name, r in runs.items()} == {
        "communes_loader": ("success", 2, 2),
        "transactions_loader": ("success", 4, 4),
        "demographics_loader": ("success", 2, 2),
        "dpe_loader": ("success", 4, 4),
    }
    assert all(r["completed_at"] > r["started_at"] for r in runs.values())
    assert runs["transactions_loader"]["metadata"] == '{"year": 2023, "scope": "france"}'


def test_views_by_name(spark, landing, warehouse):
    loading.load_all(spark, landing, warehouse, 2023)
    register_views(spark, warehouse)
    energy = spark.sql("SELECT * FROM v_dpe_stats_communes WHERE commune_nom = 'Nice'").first()
    assert (energy["nb_dpe"], energy["nb_bonne_perf"], energy["nb_mauvaise_perf"]) == (3, 2, 1)
    assert energy["pct_bonne_perf"] == Decimal("66.67")
    assert spark.sql("SELECT count(*) AS n FROM v_last_scraping_runs WHERE status = 'success'").first()["n"] == 4
    # The sales are older than the trailing year.
    assert spark.sql("SELECT * FROM v_prix_median_communes").count() == 0
    top = spark.sql(
        "SELECT dept, count(*) AS nb FROM transactions t JOIN communes c ON t.commune_id = c.code_insee "
        "GROUP BY dept ORDER BY nb DESC LIMIT 10"
    )
    assert list(map(tuple, top.collect())) == [("06", 3), ("75", 1)]


def test_departments(spark, landing, warehouse):
    loading.load_communes(spark, landing, warehouse)
    loading.load_transactions(spark, landing, warehouse, [2022, 2023], ["75"])
    assert read_table(spark, warehouse, "transactions").count() == 2
    result = loading.load_dpe(spark, landing, warehouse, ["06", "75"])
    assert (result.rows_written, result.rows_rejected) == (4, 1)


@pytest.mark.parametrize("departments", [None, ["06"]])
def test_every_landed_diagnosis_is_stored(spark, landing, warehouse, write, departments):
    write("in/dpe/dept=06", "b.csv", ",".join(DPE_COLUMNS), *[diagnosis("06088", "A")] * 60_000)
    loading.load_all(spark, landing, warehouse, 2023, departments=departments)
    stored = read_table(spark, warehouse, "dpe").where("commune_id = '06088'").count()
    assert stored == 60_003


def test_nothing_staged_is_left(spark, landing, warehouse):
    from pathlib import Path

    from toitscope import shared_folder

    loading.load_all(spark, landing, warehouse, 2023)
    with pytest.raises(loading.RowsRejected):
        loading.load_transactions(spark, landing, warehouse, [2023], on_violation="abort")
    left = Path(shared_folder(spark)) / "staging"
    assert not left.exists() or not list(left.iterdir())


class BareSession:
    """A session of a cluster that names no shared folder."""

    def __init__(self):
        self.settings = {"spark.sql.warehouse.dir": "hdfs://tables/"}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_shared_folder_must_be_named():
    from toitscope import name_shared_folder, shared_folder

    session = BareSession()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)
    assert name_shared_folder(session) == shared_folder(session) == "hdfs://tables/shared"
    session.settings["spark.checkpoint.dir"] = "hdfs://steps"
    assert name_shared_folder(session) == shared_folder(session) == "hdfs://steps"
    cluster = BareSession()
    cluster.settings |= {"spark.master": "yarn", "spark.sql.warehouse.dir": "file:/home/someone"}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        name_shared_folder(cluster)


def test_failed_load_leaves_no_rejects(spark, landing, warehouse):
    loading.load_all(spark, landing, warehouse, 2023)
    before = loading.read_quarantine(spark, warehouse).count()
    with pytest.raises(KeyConflict):
        loading.load_demographics(spark, landing, warehouse, 2023)
    assert loading.read_quarantine(spark, warehouse).count() == before


def test_repeated_load_id_counts_once(spark, landing, warehouse):
    loading.load_communes(spark, landing, warehouse)
    for _ in range(2):
        loading.load_transactions(spark, landing, warehouse, [2023], load_id="again")
    assert read_table(spark, warehouse, "transactions").count() == 4
    assert loading.read_quarantine(spark, warehouse).count() == 3


def test_update_keeps_figures_that_did_not_come(spark, landing, warehouse, write):
    loading.load_communes(spark, landing, warehouse)
    loading.load_demographics(spark, landing, warehouse, 2023)
    stored = read_table(spark, warehouse, "demographics")
    from pyspark.sql import functions as F

    from toitscope.operators.storage import replace

    replace(stored.withColumn("densite", F.lit("3.00").cast("decimal(10,2)")), warehouse, "demographics")
    write("in/population", "a.csv", "COM;PMUN", "06088;341000")
    write("in/income", "a.csv", "CODGEO;MED21", "75056;29000")
    loading.load_demographics(spark, landing, warehouse, 2023, "update")
    rows = {r["commune_id"]: r for r in read_table(spark, warehouse, "demographics").collect()}
    assert (rows["06088"]["population"], rows["06088"]["revenu_median"], rows["06088"]["densite"]) == (341000, 20000, 3)
    assert (rows["75056"]["population"], rows["75056"]["revenu_median"], rows["75056"]["densite"]) == (2100000, 29000, 3)
    assert all(r["updated_at"] > r["created_at"] for r in rows.values())


def test_lost_version_is_an_error(spark, landing, warehouse):
    import shutil

    from pyspark.errors import AnalysisException

    from toitscope.operators.commits import latest

    assert read_table(spark, warehouse, "communes").count() == 0
    loading.load_communes(spark, landing, warehouse)
    shutil.move(f"{warehouse}/communes/{latest(spark, warehouse).folders('communes')[0]}", f"{warehouse}/elsewhere")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_table(spark, warehouse, "communes").count()


def test_loads_of_one_run_share_a_pipeline(spark, landing, warehouse):
    from toitscope.operators.ledger import success_ratio_per_run

    loading.load_all(spark, landing, warehouse, 2023)
    loading.load_all(spark, landing, warehouse, 2023, skip_communes=True)
    runs = fold_runs(read_events(spark, f"{warehouse}/{EVENTS_FOLDER}"))
    ratios = sorted((r["nb_success"], r["nb_total"]) for r in success_ratio_per_run(runs).collect())
    assert ratios == [(2, 3), (4, 4)]


def test_two_targets_of_one_stream_both_get_their_rows(spark, landing, write, tmp_path):
    header = "|".join(TRANSACTION_COLUMNS)
    write("drops/day=1", "a.csv", header, sale("06088", "2023-05-01", "100000"), sale("06999", "2023-05-01", "1"))
    for name in ("one", "two"):
        warehouse = str(tmp_path / name)
        loading.load_communes(spark, landing, warehouse)
        for _ in range(2):
            ingest_transactions(spark, str(tmp_path / "drops"), warehouse, f"{warehouse}/mark")
        assert read_table(spark, warehouse, "transactions").count() == 1
        assert loading.read_quarantine(spark, warehouse).count() == 1


def test_repeated_stream_batch_counts_once(spark, landing, write, tmp_path, warehouse):
    """The batch was stored, and its commit in the checkpoint was lost."""
    import os

    header = "|".join(TRANSACTION_COLUMNS)
    write("drops/day=1", "a.csv", header, sale("06088", "2023-05-01", "100000"))
    loading.load_communes(spark, landing, warehouse)
    mark = f"{warehouse}/mark"
    ingest_transactions(spark, str(tmp_path / "drops"), warehouse, mark)
    for name in os.listdir(f"{mark}/commits"):
        if not name.endswith(".metadata"):
            os.remove(f"{mark}/commits/{name}")
    ingest_transactions(spark, str(tmp_path / "drops"), warehouse, mark)
    assert read_table(spark, warehouse, "transactions").count() == 1


def test_register_reload_keeps_stamps(spark, landing, warehouse, write):
    loading.load_communes(spark, landing, warehouse)
    before = {r["code_insee"]: r for r in read_table(spark, warehouse, "communes").collect()}
    write("in/communes", "a.csv", COMMUNE_HEADER, "06088,Nizza,06,PACA,,", "06088,Nissa,06,PACA,,", "2A004,Ajaccio,2A,Corse,,")
    loading.load_communes(spark, landing, warehouse)
    after = {r["code_insee"]: r for r in read_table(spark, warehouse, "communes").collect()}
    assert sorted(after) == ["06088", "2A004", "75056"]
    assert after["06088"]["nom"] == "Nissa" and after["06088"]["latitude"] is None
    for column in ("created_at", "updated_at"):
        assert after["06088"][column] == before["06088"][column]
    assert after["75056"] == before["75056"]


def test_abort_writes_nothing(spark, landing, warehouse):
    loading.load_communes(spark, landing, warehouse)
    with pytest.raises(loading.RowsRejected):
        loading.load_transactions(spark, landing, warehouse, [2023], on_violation="abort")
    assert read_table(spark, warehouse, "transactions").count() == 0


def test_second_load(spark, landing, warehouse):
    """Sales are appended again as they come, unless only new rows are asked for; figures clash on their key."""
    loading.load_all(spark, landing, warehouse, 2023)
    again = loading.load_transactions(spark, landing, warehouse, [2023], only_new=True)
    assert again.rows_written == 0
    assert read_table(spark, warehouse, "transactions").count() == 4
    loading.load_transactions(spark, landing, warehouse, [2023])
    assert read_table(spark, warehouse, "transactions").count() == 8
    with pytest.raises(KeyConflict):
        loading.load_demographics(spark, landing, warehouse, 2023)
    assert loading.load_demographics(spark, landing, warehouse, 2023, "skip").rows_written == 0
    loading.load_demographics(spark, landing, warehouse, 2023, "update")
    loading.load_demographics(spark, landing, warehouse, 2024)
    assert read_table(spark, warehouse, "demographics").count() == 4


def test_failed_load_is_in_the_ledger(spark, landing, warehouse, tmp_path):
    done = loading.load_all(spark, str(tmp_path / "nowhere"), warehouse, 2023, skip_communes=True)
    assert done == {"transactions": False, "demographics": False, "dpe": False}
    runs = fold_runs(read_events(spark, f"{warehouse}/{EVENTS_FOLDER}")).collect()
    assert {r["status"] for r in runs} == {"failed"}
    assert all(r["error_message"] and r["completed_at"] for r in runs)


def test_remove_communes_takes_children(spark, landing, warehouse):
    loading.load_all(spark, landing, warehouse, 2023)
    loading.remove_communes(spark, warehouse, spark.createDataFrame([("06088",)], "code_insee string"))
    left = {n: read_table(spark, warehouse, n).count() for n in ("communes", "transactions", "demographics", "dpe")}
    assert left == {"communes": 1, "transactions": 1, "demographics": 1, "dpe": 1}


def test_incremental_files(spark, write, tmp_path):
    header = "|".join(TRANSACTION_COLUMNS)
    root, target, mark = str(tmp_path / "drops"), str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        ingest_delimited(spark, root, TRANSACTIONS_SOURCE, clean_transactions, target, mark)
        return sorted(r["prix"] for r in spark.read.parquet(target).collect())

    write("drops/2024-01-01", "a.csv", header, sale("1", "2023-01-01", "1"), sale("1", "2023-01-01", "x"))
    assert run() == [1.0]
    assert run() == [1.0]
    write("drops/2024-01-02", "a.csv", header, sale("1", "2023-01-01", "2"))
    assert run() == [1.0, 2.0]


def test_trailing_year_from_stored_sales(spark, landing, warehouse):
    from pyspark.sql import functions as F

    from toitscope.plans.prices import price_stats

    loading.load_all(spark, landing, warehouse, 2023)
    tx, communes = read_table(spark, warehouse, "transactions"), read_table(spark, warehouse, "communes")
    rows = price_stats(tx, communes, F.lit(dt.date(2024, 5, 1))).collect()
    assert sorted((r["commune_nom"], r["nb_transactions"], r["prix_median"], r["prix_m2_median"]) for r in rows) == [
        ("Nice", 3, 200000.0, 4000.0),
        ("Paris", 1, 500000.0, None),
    ]
    assert price_stats(tx, communes, F.lit(dt.date(2024, 5, 2))).where("commune_nom = 'Nice'").first()["nb_transactions"] == 2
