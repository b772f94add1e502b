"""The other four sources, landing folders and file order."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from toitscope import schemas
from toitscope.functions.text import BLANKS, strip
from toitscope.operators import cleaning
from toitscope.operators.integrity import narrow
from toitscope.schemas import DPE_COLUMNS
from toitscope.sources import landing
from toitscope.sources.delimited import read_delimited
from toitscope.sources.tables import query

DPE_GOOD = dict(zip(DPE_COLUMNS, ["75056", "d", "e", "120.5", "20", "Maison individuelle", "1948", "80", "2023-01-05"]))


def dpe_line(**changes: str) -> str:
    return ",".join({**DPE_GOOD, **changes}.values())


@pytest.fixture
def dpe(spark, write):
    def run(*lines: str) -> list[dict]:
        folder = write("dpe", "a.csv", ",".join(DPE_COLUMNS), *lines)
        raw = read_delimited(spark, folder, schemas.DPE_SOURCE)
        return [row.asDict() for row in narrow(cleaning.clean_dpe(raw), "dpe").collect()]

    return run


def test_dpe_good_row(dpe):
    assert dpe(dpe_line()) == [
        {
            "commune_id": "75056",
            "classe_energetique": "D",
            "classe_ges": "E",
            "emissions_co2": Decimal("20.00"),
            "consommation_energie": Decimal("120.50"),
            "type_batiment": "maison",
            "annee_construction": 1948,
            "surface": Decimal("80.00"),
            "date_etablissement": dt.date(2023, 1, 5),
        }
    ]


@pytest.mark.parametrize("change", [{"Etiquette_DPE": "H"}, {"Etiquette_DPE": ""}, {"Code_INSEE_(BAN)": " "}])
def test_dpe_dropped(dpe, change):
    assert dpe(dpe_line(**change)) == []


@pytest.mark.parametrize(("label", "expected"), [("Z", None), ("", None), ("g", "G")])
def test_dpe_ges(dpe, label, expected):
    assert dpe(dpe_line(Etiquette_GES=label))[0]["classe_ges"] == expected


def test_dpe_one_bad_figure_empties_all(dpe):
    row = dpe(dpe_line(**{"Année_construction": "1948.0"}))[0]
    figures = ["emissions_co2", "consommation_energie", "annee_construction", "surface", "date_etablissement"]
    assert [row[name] for name in figures] == [None] * 5
    assert row["classe_energetique"] == "D"


def test_dpe_blank_date_empties_only_itself(dpe):
    row = dpe(dpe_line(**{"Date_établissement_DPE": ""}))[0]
    assert row["date_etablissement"] is None and row["surface"] == Decimal("80.00")


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("Maison individuelle", "maison"),
        ("Logement INDIVIDUEL", "maison"),
        ("Immeuble collectif", "immeuble"),
        ("Appartement dans immeuble", "appartement"),
        ("Bureau", "autre"),
        ("", "autre"),
    ],
)
def test_dpe_building_type(dpe, text, kind):
    assert dpe(dpe_line(**{"Type_bâtiment": text}))[0]["type_batiment"] == kind


def test_communes(spark, write):
    folder = write(
        "communes",
        "a.csv",
        "com_code,com_nom,dep_code,reg_nom,latitude,longitude",
        "01001,L'Abergement,01,,x,2.35",
        "01002,Old,01,Rhône,,2.35",
        "01003,Sans dept,,Rhône,1,2",
        "01002,New,01,Rhône,46.5,2.35",
    )
    raw = read_delimited(spark, folder, schemas.COMMUNES_SOURCE)
    rows = {r["code_insee"]: r for r in narrow(cleaning.fold_communes(raw), "communes").collect()}
    assert sorted(rows) == ["01001", "01002"]
    assert rows["01001"]["region"] == "" and rows["01001"]["latitude"] is None
    assert rows["01001"]["longitude"] is None
    assert rows["01002"]["nom"] == "New" and rows["01002"]["latitude"] == Decimal("46.5000000")
    one = cleaning.clean_communes(raw).where("nom = 'Old'").first()
    assert one["latitude"] is None and one["longitude"] == 2.35


def test_population_and_income(spark, write):
    people = write("pop", "a.csv", "COM;PMUN;X", "1;0;a", "2;1 200;a", "3;;a", "4;10;a", "4;x;a", "5;1;a", "5;2;a")
    raw = read_delimited(spark, people, schemas.POPULATION_SOURCE)
    population = cleaning.clean_population(raw, 2021)
    assert sorted(map(tuple, population.collect())) == [("1", 0, 2021), ("4", 10, 2021), ("5", 2, 2021)]
    money = write("inc", "a.csv", "CODGEO;MED21", "1;21000.5", "9;18000", "8;s")
    income = cleaning.clean_income(read_delimited(spark, money, schemas.INCOME_SOURCE))
    merged = narrow(cleaning.merge_demographics(population, income, 2021), "demographics")
    rows = {r["commune_id"]: r for r in merged.collect()}
    assert sorted(rows) == ["1", "4", "5", "9"]
    assert (rows["1"]["population"], rows["1"]["revenu_median"]) == (0, Decimal("21000.50"))
    assert (rows["9"]["population"], rows["9"]["revenu_median"]) == (None, Decimal("18000.00"))
    assert rows["4"]["revenu_median"] is None
    assert all(r["densite"] is None and r["nombre_menages"] is None and r["annee"] == 2021 for r in rows.values())


def test_income_column_is_a_parameter(spark, write):
    folder = write("inc", "a.csv", "CODGEO;MED20", "1;5")
    source = schemas.Source("income", ";", ["CODGEO", "MED20"], ["CODGEO", "MED20"])
    income = cleaning.clean_income(read_delimited(spark, folder, source), value="MED20")
    assert income.collect()[0].asDict() == {"commune_id": "1", "revenu_median": 5.0}


def test_last_row_wins_across_splits(spark, write):
    """One file cut into many blocks: the order of the file, not of the tasks, decides."""
    lines = [f"{i % 7};{i}" for i in range(20_000)]
    folder = write("pop", "a.csv", "COM;PMUN", *lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        raw = read_delimited(spark, folder, schemas.POPULATION_SOURCE)
        assert raw.rdd.getNumPartitions() > 4
        got = {r["commune_id"]: r["population"] for r in cleaning.clean_population(raw, 1).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {str(i % 7): i for i in range(20_000)}


def test_landing_folders(spark, write, tmp_path):
    header = "|".join(schemas.TRANSACTION_COLUMNS)
    for year in (2022, 2023):
        for dept in ("06", "2A"):
            row = f"{dept}001|{year}-01-01|1|Maison|1|1|Vente|1|R|00000"
            write(f"transactions/year={year}/dept={dept}", "a.csv", header, row)
    raw = landing.read_transactions(spark, str(tmp_path), [2023], ["06"])
    assert [(r["code_commune"], r["year"], r["dept"]) for r in raw.collect()] == [("06001", "2023", "06")]
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert landing.read_transactions(spark, str(tmp_path)).count() == 4
    assert landing.read_transactions(spark, str(tmp_path), departments=[]).count() == 4


def test_strip_takes_what_counts_as_blank(spark):
    from pyspark.sql import functions as F

    assert len(BLANKS) == 29 and BLANKS.strip() == ""
    assert all(chr(i) in BLANKS for i in range(0x110000) if chr(i).isspace())
    row = spark.range(1).select(strip(F.lit(BLANKS + "a" + BLANKS + "b" + BLANKS)).alias("x")).first()
    assert row["x"] == "a" + BLANKS + "b"


def test_parameterised_query(spark):
    runs = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    found = query(spark, "SELECT * FROM runs WHERE id = :id", {"id": 2}, runs=runs)
    assert [row.asDict() for row in found.collect()] == [{"id": 2, "name": "b"}]
    assert not spark.catalog.tableExists("runs")
