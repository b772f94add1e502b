"""From raw text to typed values. Every expression is a Spark built-in and stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters that count as blank at either end of a field.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "            "
    "    　"
)
# Spark's own cast takes "12d", "nan" and "inf" for numbers and "2023-01" for a date; and a cast that fails
# costs far more than a pattern that does not match.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
WHOLE = r"^[+-]?\d+$"
DATE = r"^(?!0000)\d{4}-(0?[1-9]|1[0-2])-(0?[1-9]|[12]\d|3[01])$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def field(raw: Column) -> Column:
    """Stripped field; a missing one reads as blank, not NULL."""
    return strip(F.coalesce(raw, F.lit("")))


def joined_field(*raws: Column) -> Column:
    """Fields joined by one space and stripped as a whole; the parts keep their own blanks."""
    return strip(F.concat_ws(" ", *[F.coalesce(raw, F.lit("")) for raw in raws]))


def to_double(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_int(text: Column) -> Column:
    return F.when(text.rlike(WHOLE), text.try_cast("int"))


def to_date(text: Column) -> Column:
    """Year-month-day with one- or two-digit month and day."""
    return F.when(text.rlike(DATE), text.try_cast("date"))


def unreadable(text: Column, parsed: Column) -> Column:
    """The field has content but its conversion failed (a blank field is no failure)."""
    return (text != "") & parsed.isNull()


def any_of(*conditions: Column) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out
