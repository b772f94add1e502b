"""One cleaner per source: raw text rows in, typed rows out.

``screen_*`` keeps every row and says in ``_reject`` why it cannot be loaded (NULL: it can);
``clean_*`` returns only the loadable ones with the columns of the target table.
Numbers stay wide (double) until ``integrity.narrow`` so that a value out of the target's range is seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toitscope.functions.labels import building_type, energy_class, property_type
from toitscope.functions.measures import price_per_m2
from toitscope.functions.text import (
    any_of,
    field,
    joined_field,
    to_date,
    to_double,
    to_int,
    unreadable,
)
from toitscope.operators.ranking import latest_per_key
from toitscope.schemas import ENERGY_CLASSES, TABLES

BLANK, BAD_VALUE, BAD_LABEL = "blank_required", "unreadable_value", "unknown_label"


def _reject(raw: DataFrame, *reasons: tuple[Column, str]) -> Column:
    """First reason that applies, a damaged row before all others."""
    out = F.col("_damage") if "_damage" in raw.columns else F.lit(None).cast("string")
    return F.coalesce(out, *[F.when(condition, F.lit(code)) for condition, code in reasons])


def _blank(*fields: Column) -> Column:
    return any_of(*[value == "" for value in fields])


def _kept(screened: DataFrame) -> DataFrame:
    """Rows without a reject reason.

    A plain filter would be moved below the parsing and repeat it; rows that give no struct are parsed once.
    """
    columns = [name for name in screened.columns if name not in ("_reject", "_pos")]
    return screened.select(F.inline(F.when(F.col("_reject").isNull(), F.array(F.struct(*columns)))))


def _all_or_none(texts: DataFrame, readers: dict[str, tuple[str, Callable[[Column], Column]]]) -> DataFrame:
    """Adds the fields of ``readers`` (name: text column, conversion), which stand or fall together:
    one failed conversion makes all of them NULL. Each text is converted once.
    """
    parsed = texts.select("*", *[read(F.col(text)).alias(f"_{name}") for name, (text, read) in readers.items()])
    broken = any_of(*[unreadable(F.col(text), F.col(f"_{name}")) for name, (text, _) in readers.items()])
    return parsed.withColumn("_broken", broken).select(
        *texts.columns, *[F.when(~F.col("_broken"), F.col(f"_{name}")).alias(name) for name in readers]
    )


def _place(raw: DataFrame) -> list[str]:
    return [name for name in ("_pos",) if name in raw.columns]


def screen_communes(raw: DataFrame) -> DataFrame:
    """The region may be blank; an unreadable coordinate takes the other one with it."""
    texts = raw.select(
        field(F.col("com_code")).alias("code_insee"),
        field(F.col("com_nom")).alias("nom"),
        field(F.col("dep_code")).alias("dept"),
        field(F.col("reg_nom")).alias("region"),
        field(F.col("latitude")).alias("lat"),
        field(F.col("longitude")).alias("lon"),
        *_damage(raw),
        *_place(raw),
    )
    located = _all_or_none(texts, {"latitude": ("lat", to_double), "longitude": ("lon", to_double)})
    return located.select(
        "code_insee",
        "nom",
        "dept",
        "region",
        "latitude",
        "longitude",
        *_place(raw),
        _reject(located, (_blank(F.col("code_insee"), F.col("nom"), F.col("dept")), BLANK)).alias("_reject"),
    )


def clean_communes(raw: DataFrame) -> DataFrame:
    return _kept(screen_communes(raw))


def fold_communes(raw: DataFrame, order: Column | None = None) -> DataFrame:
    """Cleaned register with the last row of each code, in file order unless ``order`` says otherwise."""
    screened = screen_communes(raw).where(F.col("_reject").isNull()).drop("_reject")
    folded = latest_per_key(screened, ["code_insee"], F.col("_pos") if order is None else order)
    return folded.drop("_pos")


def screen_transactions(raw: DataFrame) -> DataFrame:
    """A blank surface or room count is NULL; an unreadable price, date, surface or room count rejects."""
    texts = raw.select(
        field(F.col("code_commune")).alias("commune_id"),
        field(F.col("date_mutation")).alias("jour"),
        field(F.col("valeur_fonciere")).alias("valeur"),
        field(F.col("type_local")).alias("type_local"),
        field(F.col("surface_reelle_bati")).alias("bati"),
        field(F.col("nombre_pieces_principales")).alias("pieces"),
        field(F.col("nature_mutation")).alias("nature_mutation"),
        joined_field(F.col("adresse_numero"), F.col("adresse_nom_voie")).alias("adresse"),
        field(F.col("code_postal")).alias("code_postal"),
        *_damage(raw),
        *_place(raw),
    )
    parsed = texts.select(
        "*",
        to_date(F.col("jour")).alias("date_transaction"),
        to_double(F.col("valeur")).alias("prix"),
        to_double(F.col("bati")).alias("surface"),
        to_int(F.col("pieces")).alias("nombre_pieces"),
    )
    broken = any_of(
        unreadable(F.col("valeur"), F.col("prix")),
        unreadable(F.col("jour"), F.col("date_transaction")),
        unreadable(F.col("bati"), F.col("surface")),
        unreadable(F.col("pieces"), F.col("nombre_pieces")),
    )
    return parsed.select(
        "commune_id",
        "date_transaction",
        "prix",
        "surface",
        price_per_m2(F.col("prix"), F.col("surface")).alias("prix_m2"),
        property_type(F.col("type_local")).alias("type_bien"),
        "nombre_pieces",
        "nature_mutation",
        "adresse",
        "code_postal",
        *_place(raw),
        _reject(
            parsed,
            (_blank(F.col("commune_id"), F.col("jour"), F.col("valeur")), BLANK),
            (broken, BAD_VALUE),
        ).alias("_reject"),
    )


def clean_transactions(raw: DataFrame) -> DataFrame:
    return _kept(screen_transactions(raw))


def screen_dpe(raw: DataFrame) -> DataFrame:
    """One unreadable figure empties all five figures; the row stays if code and energy class are good."""
    texts = raw.select(
        field(F.col("`Code_INSEE_(BAN)`")).alias("commune_id"),
        F.upper(field(F.col("Etiquette_DPE"))).alias("dpe"),
        energy_class(field(F.col("Etiquette_GES"))).alias("classe_ges"),
        field(F.col("Emission_GES_5_usages")).alias("ges"),
        field(F.col("Conso_5_usages_é_finale")).alias("conso"),
        building_type(field(F.col("Type_bâtiment"))).alias("type_batiment"),
        field(F.col("Année_construction")).alias("annee"),
        field(F.col("Surface_habitable_logement")).alias("surf"),
        field(F.col("Date_établissement_DPE")).alias("jour"),
        *_damage(raw),
        *_place(raw),
    )
    figured = _all_or_none(
        texts,
        {
            "emissions_co2": ("ges", to_double),
            "consommation_energie": ("conso", to_double),
            "annee_construction": ("annee", to_int),
            "surface": ("surf", to_double),
            "date_etablissement": ("jour", to_date),
        },
    )
    known = F.col("dpe").isin(ENERGY_CLASSES)
    return figured.select(
        "commune_id",
        F.when(known, F.col("dpe")).alias("classe_energetique"),
        "classe_ges",
        "emissions_co2",
        "consommation_energie",
        "type_batiment",
        "annee_construction",
        "surface",
        "date_etablissement",
        *_place(raw),
        _reject(figured, (_blank(F.col("commune_id"), F.col("dpe")), BLANK), (~known, BAD_LABEL)).alias(
            "_reject"
        ),
    )


def clean_dpe(raw: DataFrame) -> DataFrame:
    return _kept(screen_dpe(raw))


def _screen_figure(raw: DataFrame, code: str, value: str, name: str, read) -> DataFrame:
    texts = raw.select(
        field(F.col(code)).alias("commune_id"), field(F.col(value)).alias("figure"), *_damage(raw), *_place(raw)
    )
    parsed = texts.withColumn(name, read(F.col("figure")))
    return parsed.select(
        "commune_id",
        name,
        *_place(raw),
        _reject(
            parsed,
            (_blank(F.col("commune_id"), F.col("figure")), BLANK),
            (unreadable(F.col("figure"), F.col(name)), BAD_VALUE),
        ).alias("_reject"),
    )


def screen_population(raw: DataFrame, code: str = "COM", value: str = "PMUN") -> DataFrame:
    return _screen_figure(raw, code, value, "population", to_int)


def screen_income(raw: DataFrame, code: str = "CODGEO", value: str = "MED21") -> DataFrame:
    return _screen_figure(raw, code, value, "revenu_median", to_double)


def _fold_figure(screened: DataFrame, order: str) -> DataFrame:
    good = screened.where(F.col("_reject").isNull()).drop("_reject")
    return latest_per_key(good, ["commune_id"], F.col(order)).drop(order)


def clean_population(raw: DataFrame, year: int, code: str = "COM", value: str = "PMUN") -> DataFrame:
    """(commune_id, population, annee): the last readable value of each code in file order."""
    return _fold_figure(screen_population(raw, code, value), "_pos").withColumn("annee", F.lit(year))


def clean_income(raw: DataFrame, code: str = "CODGEO", value: str = "MED21") -> DataFrame:
    """(commune_id, revenu_median): the last readable value of each code in file order."""
    return _fold_figure(screen_income(raw, code, value), "_pos")


def merge_demographics(population: DataFrame, income: DataFrame, year: int) -> DataFrame:
    """One row per code found in either input; measures no source gives are typed NULLs."""
    kinds = {f.name: f.dataType for f in TABLES["demographics"].fields}

    def absent(name: str) -> Column:
        return F.lit(None).cast(kinds[name]).alias(name)

    both = population.select("commune_id", "population").join(
        income.select("commune_id", "revenu_median"), "commune_id", "full_outer"
    )
    return both.select(
        "commune_id",
        F.lit(year).alias("annee"),
        "population",
        absent("densite"),
        "revenu_median",
        absent("taux_chomage"),
        absent("nombre_menages"),
        absent("taille_moyenne_menage"),
    )


def key_union(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found in either input, each once."""
    return left.select(key).union(right.select(key)).distinct()


def _damage(raw: DataFrame) -> list[str]:
    return [name for name in ("_damage",) if name in raw.columns]
