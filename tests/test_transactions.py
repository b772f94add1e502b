"""Cleaning of sales files, one rule per case, through real files."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from toitscope.operators.cleaning import clean_transactions, screen_transactions
from toitscope.operators.integrity import narrow
from toitscope.schemas import TRANSACTION_COLUMNS, TRANSACTIONS_SOURCE
from toitscope.sources.delimited import read_delimited

HEADER = "|".join(TRANSACTION_COLUMNS)
GOOD = {
    "code_commune": "75056",
    "date_mutation": "2023-05-10",
    "valeur_fonciere": "300000",
    "type_local": "Appartement",
    "surface_reelle_bati": "50",
    "nombre_pieces_principales": "2",
    "nature_mutation": "Vente",
    "adresse_numero": "12",
    "adresse_nom_voie": "RUE X",
    "code_postal": "75001",
}


def line(**changes: str) -> str:
    return "|".join({**GOOD, **changes}.values())


@pytest.fixture
def load(spark, write):
    def run(*lines: str) -> list[dict]:
        folder = write("tx", "a.csv", HEADER, *lines)
        raw = read_delimited(spark, folder, TRANSACTIONS_SOURCE)
        return [row.asDict() for row in narrow(clean_transactions(raw), "transactions").collect()]

    return run


def test_good_row(load):
    assert load(line()) == [
        {
            "commune_id": "75056",
            "date_transaction": dt.date(2023, 5, 10),
            "prix": Decimal("300000.00"),
            "surface": Decimal("50.00"),
            "prix_m2": Decimal("6000.00"),
            "type_bien": "appartement",
            "nombre_pieces": 2,
            "nature_mutation": "Vente",
            "adresse": "12 RUE X",
            "code_postal": "75001",
        }
    ]


@pytest.mark.parametrize(
    ("column", "value"),
    [
        ("surface_reelle_bati", "abc"),
        ("nombre_pieces_principales", "3.0"),
        ("valeur_fonciere", ""),
        ("valeur_fonciere", "12d"),
        ("valeur_fonciere", "nan"),
        ("valeur_fonciere", "1_000"),
        ("code_commune", " "),
        ("date_mutation", ""),
        ("date_mutation", "2023-02-30"),
        ("date_mutation", "2023-01"),
        ("date_mutation", "2023-01-05T00:00:00"),
        ("date_mutation", "2023-13-01"),
        ("date_mutation", "0000-01-01"),
    ],
)
def test_dropped(load, column, value):
    assert load(line(**{column: value})) == []


@pytest.mark.parametrize(
    ("column", "value", "target", "expected"),
    [
        ("surface_reelle_bati", "", "surface", None),
        ("surface_reelle_bati", "", "prix_m2", None),
        ("surface_reelle_bati", "0", "surface", Decimal("0.00")),
        ("surface_reelle_bati", "0", "prix_m2", None),
        ("surface_reelle_bati", "-5", "surface", Decimal("-5.00")),
        ("surface_reelle_bati", "-5", "prix_m2", None),
        ("nombre_pieces_principales", "", "nombre_pieces", None),
        ("valeur_fonciere", " 1e5 ", "prix", Decimal("100000.00")),
        ("valeur_fonciere", "0", "prix", Decimal("0.00")),
        ("valeur_fonciere", "-10", "prix", Decimal("-10.00")),
        ("date_mutation", "2023-1-5", "date_transaction", dt.date(2023, 1, 5)),
        ("type_local", "Terrain", "type_bien", "autre"),
        ("type_local", "", "type_bien", "autre"),
        ("type_local", "Maison", "type_bien", "maison"),
        ("type_local", "Dépendance", "type_bien", "dependance"),
        ("type_local", "Local industriel. commercial ou assimilé", "type_bien", "local_commercial"),
        ("adresse_numero", "", "adresse", "RUE X"),
        ("code_postal", "", "code_postal", ""),
        ("nature_mutation", "", "nature_mutation", ""),
        ("code_commune", " 75056 ", "commune_id", "75056"),
        ("adresse_nom_voie", '"RUE ""DU"" | BAC"', "adresse", '12 RUE "DU" | BAC'),
    ],
)
def test_kept(load, column, value, target, expected):
    rows = load(line(**{column: value}))
    assert [row[target] for row in rows] == [expected]


def test_blank_address(load):
    assert load(line(adresse_numero="", adresse_nom_voie=""))[0]["adresse"] == ""


def test_price_per_m2_rounds_half_up(load):
    rows = load(line(valeur_fonciere="10.01", surface_reelle_bati="2"), line(valeur_fonciere="2.675", surface_reelle_bati="1"))
    assert [row["prix_m2"] for row in rows] == [Decimal("5.01"), Decimal("2.68")]


def test_short_row_is_set_aside_and_long_row_kept(spark, write):
    folder = write("tx", "a.csv", HEADER, line().rsplit("|", 1)[0], line() + "|surplus", line())
    screened = screen_transactions(read_delimited(spark, folder, TRANSACTIONS_SOURCE))
    assert sorted(str(row["_reject"]) for row in screened.collect()) == ["None", "None", "short_row"]


def test_undecodable_text_is_set_aside(spark, write):
    folder = write("tx", "a.csv", HEADER, line(adresse_nom_voie="RUE É"), encoding="latin-1")
    screened = screen_transactions(read_delimited(spark, folder, TRANSACTIONS_SOURCE))
    assert [row["_reject"] for row in screened.collect()] == ["bad_encoding"]


def test_wrong_separator_is_an_error(spark, write):
    folder = write("tx", "a.csv", HEADER.replace("|", ","), line().replace("|", ","))
    with pytest.raises(ValueError, match="code_commune"):
        read_delimited(spark, folder, TRANSACTIONS_SOURCE)
    raw = read_delimited(spark, folder, TRANSACTIONS_SOURCE, separator=",")
    assert clean_transactions(raw).count() == 1


def test_absent_optional_column_reads_blank(spark, write):
    short = [name for name in TRANSACTION_COLUMNS if name != "type_local"]
    values = "|".join(GOOD[name] for name in short)
    raw = read_delimited(spark, write("tx", "a.csv", "|".join(short), values), TRANSACTIONS_SOURCE)
    assert clean_transactions(raw).first()["type_bien"] == "autre"
