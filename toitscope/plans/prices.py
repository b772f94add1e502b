"""Price statistics per commune and per department."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toitscope.functions.measures import months_before
from toitscope.operators.kept import BLOCKS, MEASURES
from toitscope.operators.medians import amount_counts, amount_means, amount_stats, means_of_sums
from toitscope.operators.ranking import top

WINDOW_MONTHS = 12


def first_day_of_window(as_of: Column | None = None) -> Column:
    return months_before(F.current_date() if as_of is None else as_of, WINDOW_MONTHS)


def trailing_year(transactions: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Sales from twelve months before ``as_of`` (default: today) on, first day included."""
    first_day = first_day_of_window(as_of)
    recent = transactions.where(F.col("date_transaction") >= first_day)
    if "year" in transactions.columns:
        # The stored table has one folder per year: skip the older ones unopened.
        recent = recent.where(F.col("year") >= F.year(first_day))
    return recent


def sale_stats(
    transactions: DataFrame,
    keys: list[str],
    measures: list[str],
    members: DataFrame | None = None,
    mean_surface: bool = False,
) -> DataFrame:
    """Sales, and mean and median of the ``measures`` (prix, prix_m2), per group; see ``amount_stats`` for groups.

    A sale becomes one row per measure, so only those that are read should be asked for. The mean surface needs no
    such rows: it is a sum and a count per key.
    """
    placed = transactions.where(F.col("commune_id").isNotNull())
    out = _sale_figures(amount_counts(placed, keys, measures), keys, measures, members)
    if not mean_surface:
        return out
    return _with_surface(out, amount_means(placed, keys, "surface", members))


def stats_of_counts(
    counts: DataFrame,
    sums: DataFrame,
    keys: list[str],
    measures: list[str],
    members: DataFrame | None = None,
    mean_surface: bool = False,
) -> DataFrame:
    """``sale_stats`` from kept counts of the amounts and their block totals; ``measures`` begin with the price."""
    priced = sums.where(F.col("measure") < len(measures))
    out = _sale_figures(counts, keys, measures, members, priced)
    if not mean_surface:
        return out
    return _with_surface(out, means_of_sums(sums, keys, MEASURES.index("surface"), "surface", members))


def _sale_figures(
    counts: DataFrame, keys: list[str], measures: list[str], members: DataFrame | None, sums: DataFrame | None = None
) -> DataFrame:
    stats = amount_stats(counts, keys, {name: BLOCKS[name] for name in measures}, members, sums)
    figures = ["nb_rows", *[f"{name}_{kind}" for name in measures for kind in ("mean", "median")]]
    groups = [name for name in stats.columns if name not in figures]
    return stats.select(
        *groups,
        F.col("nb_rows").alias("nb_transactions"),
        *[F.col(f"{name}_median") for name in measures],
        *([F.col("prix_mean").alias("prix_moyen")] if "prix" in measures else []),
    )


def _with_surface(figures: DataFrame, means: DataFrame) -> DataFrame:
    surfaces = means.withColumnRenamed("surface_mean", "surface_moyenne")
    return figures.join(surfaces, [name for name in surfaces.columns if name != "surface_moyenne"])


def price_stats(transactions: DataFrame, communes: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Count, median and mean prices, mean surface per commune over the trailing year.

    Sales are reduced to one row per commune before they meet the register, so the sales themselves are
    never joined.
    """
    figures = sale_stats(trailing_year(transactions, as_of), ["commune_id"], ["prix", "prix_m2"], mean_surface=True)
    return of_register(figures, communes)


def of_register(figures: DataFrame, communes: DataFrame) -> DataFrame:
    """Figures per commune with its name and place; those of a commune the register does not know drop out."""
    register = communes.select(
        F.col("code_insee").alias("commune_id"), F.col("nom").alias("commune_nom"), "dept", "region"
    )
    return figures.join(register, "commune_id").select(
        "commune_id",
        "commune_nom",
        "dept",
        "region",
        "nb_transactions",
        "prix_median",
        "prix_m2_median",
        "prix_moyen",
        "surface_moyenne",
    )


def department_prices(transactions: DataFrame, communes: DataFrame) -> DataFrame:
    """Count and mean price per department, summed per commune first and joined after."""
    per_commune = transactions.groupBy("commune_id").agg(
        F.count("*").alias("nb"), F.count("prix").alias("nb_prix"), F.sum("prix").alias("total")
    )
    return per_department(per_commune, communes)


def per_department(per_commune: DataFrame, communes: DataFrame) -> DataFrame:
    register = communes.select(F.col("code_insee").alias("commune_id"), "dept")
    total, number = F.sum("total").cast("decimal(26,2)"), F.sum("nb_prix").cast("decimal(18,0)")
    return (
        per_commune.join(register, "commune_id")
        .groupBy("dept")
        .agg(
            F.sum("nb").alias("nb_transactions"),
            F.try_divide(total, number).cast("decimal(16,6)").alias("prix_moyen"),
        )
    )


def busiest_departments(transactions: DataFrame, communes: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` departments with most sales; the code breaks ties."""
    return top(
        department_prices(transactions, communes), [F.desc("nb_transactions"), F.asc("dept")], n
    )
