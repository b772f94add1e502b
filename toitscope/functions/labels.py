"""Label mappings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from toitscope.schemas import ENERGY_CLASSES

# Property labels of the sales files and the category of each.
PROPERTY_TYPES = {
    "Maison": "maison",
    "Appartement": "appartement",
    "Dépendance": "dependance",
    "Local industriel. commercial ou assimilé": "local_commercial",
}
# Word found in a building description, and its category; the first hit counts.
BUILDING_WORDS = [
    ("appartement", "appartement"),
    ("maison", "maison"),
    ("individuel", "maison"),
    ("immeuble", "immeuble"),
]
OTHER = "autre"


def property_type(label: Column) -> Column:
    pairs = [F.lit(part) for pair in PROPERTY_TYPES.items() for part in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), label), F.lit(OTHER))


def building_type(description: Column) -> Column:
    lowered = F.lower(description)
    hits = [F.when(lowered.contains(word), F.lit(kind)) for word, kind in BUILDING_WORDS]
    return F.coalesce(*hits, F.lit(OTHER))


def energy_class(text: Column) -> Column:
    """Upper-cased label, NULL when blank or outside A..G."""
    upper = F.upper(text)
    return F.when(upper.isin(ENERGY_CLASSES), upper)
