"""Source columns, target tables and the row rules the targets impose."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names of the published files.
COMMUNE_COLUMNS = ["com_code", "com_nom", "dep_code", "reg_nom", "latitude", "longitude"]
TRANSACTION_COLUMNS = [
    "code_commune",
    "date_mutation",
    "valeur_fonciere",
    "type_local",
    "surface_reelle_bati",
    "nombre_pieces_principales",
    "nature_mutation",
    "adresse_numero",
    "adresse_nom_voie",
    "code_postal",
]
POPULATION_COLUMNS = ["COM", "PMUN"]
INCOME_COLUMNS = ["CODGEO", "MED21"]
DPE_COLUMNS = [
    "Code_INSEE_(BAN)",
    "Etiquette_DPE",
    "Etiquette_GES",
    "Conso_5_usages_é_finale",
    "Emission_GES_5_usages",
    "Type_bâtiment",
    "Année_construction",
    "Surface_habitable_logement",
    "Date_établissement_DPE",
]


@dataclass(frozen=True)
class Source:
    """A delimited file family: separator, columns read, and those a row cannot do without."""

    name: str
    separator: str
    columns: list[str]
    required: list[str]
    optional: list[str] = field(default_factory=list)


COMMUNES_SOURCE = Source("communes", ",", COMMUNE_COLUMNS, ["com_code", "com_nom", "dep_code"])
TRANSACTIONS_SOURCE = Source(
    "transactions", "|", TRANSACTION_COLUMNS, ["code_commune", "date_mutation", "valeur_fonciere"]
)
POPULATION_SOURCE = Source("population", ";", POPULATION_COLUMNS, ["COM", "PMUN"])
INCOME_SOURCE = Source("income", ";", INCOME_COLUMNS, ["CODGEO", "MED21"])
DPE_SOURCE = Source("dpe", ",", DPE_COLUMNS, ["Code_INSEE_(BAN)", "Etiquette_DPE"])


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


def _decimal(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


TEXT, INT, DAY, STAMP = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampNTZType()

# Names, types and nullability of the target tables.
TABLES: dict[str, T.StructType] = {
    "communes": _schema(
        ("code_insee", TEXT, False),
        ("nom", TEXT, False),
        ("dept", TEXT, False),
        ("region", TEXT, False),
        ("latitude", _decimal(10, 7), True),
        ("longitude", _decimal(10, 7), True),
        ("population_actuelle", INT, True),
        ("created_at", STAMP, True),
        ("updated_at", STAMP, True),
    ),
    "transactions": _schema(
        ("commune_id", TEXT, False),
        ("date_transaction", DAY, False),
        ("prix", _decimal(12, 2), False),
        ("surface", _decimal(10, 2), True),
        ("prix_m2", _decimal(10, 2), True),
        ("type_bien", TEXT, False),
        ("nombre_pieces", INT, True),
        ("nature_mutation", TEXT, True),
        ("adresse", TEXT, True),
        ("code_postal", TEXT, True),
        ("created_at", STAMP, True),
    ),
    "demographics": _schema(
        ("commune_id", TEXT, False),
        ("annee", INT, False),
        ("population", INT, True),
        ("densite", _decimal(10, 2), True),
        ("revenu_median", _decimal(10, 2), True),
        ("taux_chomage", _decimal(5, 2), True),
        ("nombre_menages", INT, True),
        ("taille_moyenne_menage", _decimal(4, 2), True),
        ("created_at", STAMP, True),
        ("updated_at", STAMP, True),
    ),
    "dpe": _schema(
        ("commune_id", TEXT, False),
        ("classe_energetique", TEXT, False),
        ("classe_ges", TEXT, True),
        ("emissions_co2", _decimal(10, 2), True),
        ("consommation_energie", _decimal(10, 2), True),
        ("type_batiment", TEXT, True),
        ("annee_construction", INT, True),
        ("surface", _decimal(10, 2), True),
        ("date_etablissement", DAY, True),
        ("created_at", STAMP, True),
    ),
    "infrastructure": _schema(
        ("commune_id", TEXT, False),
        ("type_equipement", TEXT, False),
        ("nombre", INT, False),
        ("nom", TEXT, True),
        ("adresse", TEXT, True),
        ("latitude", _decimal(10, 7), True),
        ("longitude", _decimal(10, 7), True),
        ("created_at", STAMP, True),
        ("updated_at", STAMP, True),
    ),
    "scraping_history": _schema(
        ("id", TEXT, False),
        ("scraper_name", TEXT, False),
        ("started_at", STAMP, False),
        ("completed_at", STAMP, True),
        ("status", TEXT, False),
        ("records_processed", T.LongType(), True),
        ("error_message", TEXT, True),
        ("metadata", TEXT, True),
    ),
}

# Longest text each target column takes.
MAX_LENGTH: dict[str, dict[str, int]] = {
    "communes": {"code_insee": 5, "nom": 255, "dept": 3, "region": 100},
    "transactions": {"commune_id": 5, "type_bien": 50, "nature_mutation": 100, "code_postal": 5},
    "demographics": {"commune_id": 5},
    "dpe": {"commune_id": 5, "classe_energetique": 1, "classe_ges": 1, "type_batiment": 50},
    "infrastructure": {"commune_id": 5, "type_equipement": 100, "nom": 255},
    "scraping_history": {"scraper_name": 100, "status": 20},
}

# Defaults of the target columns ("now" is the load time).
DEFAULTS: dict[str, dict[str, object]] = {
    "communes": {"created_at": "now", "updated_at": "now"},
    "transactions": {"created_at": "now"},
    "demographics": {"created_at": "now", "updated_at": "now"},
    "dpe": {"created_at": "now"},
    "infrastructure": {"nombre": 1, "created_at": "now", "updated_at": "now"},
    "scraping_history": {"started_at": "now", "records_processed": 0},
}

UNIQUE_KEYS: dict[str, list[str]] = {
    "communes": ["code_insee"],
    "demographics": ["commune_id", "annee"],
}

# Closed label sets.
ENERGY_CLASSES = ["A", "B", "C", "D", "E", "F", "G"]
GOOD_CLASSES = ["A", "B", "C"]
BAD_CLASSES = ["F", "G"]
ALLOWED: dict[str, dict[str, list[str]]] = {
    "dpe": {"classe_energetique": ENERGY_CLASSES, "classe_ges": ENERGY_CLASSES}
}

CHILD_TABLES = ["transactions", "demographics", "dpe", "infrastructure"]
