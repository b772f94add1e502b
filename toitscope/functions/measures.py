"""Arithmetic shared by cleaning and analysis."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def price_per_m2(price: Column, surface: Column) -> Column:
    """Price over surface to the cent, rounded half up; NULL unless surface > 0.

    Exact for amounts of up to ten decimals: a remainder of decimals leaves a quotient that is a whole number.
    """
    p, s = F.abs(price).try_cast("decimal(30,10)"), surface.try_cast("decimal(30,10)")
    usable = F.when(s > 0, s)
    # Half up: floor((2a + b) / 2b) with a = 100 p, b = s.
    twice = (p * F.lit(200).cast("decimal(3,0)") + usable).cast("decimal(38,10)")
    whole = (usable * F.lit(2).cast("decimal(1,0)")).cast("decimal(31,10)")
    cents = F.try_divide((twice - twice % whole).cast("decimal(38,10)"), whole)
    return F.signum(price) * cents.cast("double") / 100


def share_pct(part: Column, whole: Column) -> Column:
    """Part of a whole count in percent with two decimals, rounded half up in decimals."""
    hundredfold = (part * 100).cast("decimal(20,0)")
    return F.round(F.try_divide(hundredfold, whole.cast("decimal(17,0)")), 2).cast("decimal(5,2)")


def seconds_between(start: Column, end: Column) -> Column:
    """Length in seconds with microseconds; NULL while either end is missing."""
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("double")


def months_before(day: Column, months: int) -> Column:
    return F.add_months(day, -months)


def json_or_null(**fields: Column) -> Column:
    """JSON text of the given fields; NULL when every one of them is NULL."""
    text = F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
    return F.when(F.coalesce(*[value.cast("string") for value in fields.values()]).isNotNull(), text)
