"""Where landed files lie, and which of their folders to read.

Layout: ``<root>/<source>/`` for communes, population and income;
``<root>/transactions/year=<yyyy>/dept=<code>/`` and ``<root>/dpe/dept=<code>/`` for the large two, so that
a year or department choice prunes folders before any file is opened. ``quoted_breaks`` is for files whose quoted fields
hold line breaks.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toitscope.schemas import (
    COMMUNES_SOURCE,
    DPE_SOURCE,
    INCOME_SOURCE,
    POPULATION_SOURCE,
    TRANSACTIONS_SOURCE,
)
from toitscope.sources.delimited import read_delimited


def read_communes(spark: SparkSession, root: str, glob: str = "*.csv", quoted_breaks: bool = False) -> DataFrame:
    return read_delimited(spark, f"{root}/communes", COMMUNES_SOURCE, glob=glob, quoted_breaks=quoted_breaks)


def read_transactions(
    spark: SparkSession,
    root: str,
    years: list[int] | None = None,
    departments: list[str] | None = None,
    separator: str | None = None,
    glob: str = "*.csv",
    quoted_breaks: bool = False,
) -> DataFrame:
    return read_delimited(
        spark,
        f"{root}/transactions",
        TRANSACTIONS_SOURCE,
        separator=separator,
        glob=glob,
        folders=chosen(years, departments),
        quoted_breaks=quoted_breaks,
    )


def read_population(spark: SparkSession, root: str, glob: str = "*.csv", quoted_breaks: bool = False) -> DataFrame:
    return read_delimited(spark, f"{root}/population", POPULATION_SOURCE, glob=glob, quoted_breaks=quoted_breaks)


def read_income(spark: SparkSession, root: str, glob: str = "*.csv", quoted_breaks: bool = False) -> DataFrame:
    return read_delimited(spark, f"{root}/income", INCOME_SOURCE, glob=glob, quoted_breaks=quoted_breaks)


def read_dpe(
    spark: SparkSession,
    root: str,
    departments: list[str] | None = None,
    glob: str = "*.csv",
    quoted_breaks: bool = False,
) -> DataFrame:
    return read_delimited(
        spark, f"{root}/dpe", DPE_SOURCE, glob=glob, folders=chosen(None, departments), quoted_breaks=quoted_breaks
    )


def chosen(years: list[int] | None = None, departments: list[str] | None = None) -> Column | None:
    """Condition for the given years and departments; ``None`` or an empty list means all of them."""
    conditions = []
    if years:
        conditions.append(F.col("year").isin([str(year) for year in years]))
    if departments:
        conditions.append(F.col("dept").isin(departments))
    return reduce(and_, conditions) if conditions else None
