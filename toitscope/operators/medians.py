"""Exact medians, counts and means of money amounts for groups of any size.

Rows are first counted per (key, amount): each task does that on its own before anything is shuffled, and it
spreads a hot key over all its amounts. The middle rank is then found in two steps: the block of amounts it lies
in, from block totals, and the amount inside that block. Only amounts of such blocks go on to the second step.

With decimal(12,2) prices in blocks of 10^6 cents there are at most 10^6 blocks per group and 10^6 amounts per block,
so no step collects an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


# What a middle block carries along: its ranks and the figures of its group.
CARRIED = ["from_rank", "to_rank", "nb_rows", "nb_values", "total"]


def cents(amount: Column) -> Column:
    """Amount in whole cents."""
    return (amount.cast("decimal(14,2)") * F.lit(100)).cast("bigint")


def amount_counts(df: DataFrame, keys: list[str], amounts: list[str]) -> DataFrame:
    """(keys, measure, units, n): how often each amount in cents occurs, NULL included.

    ``measure`` is the place of the amount's column in ``amounts``.
    """
    entries = [F.struct(F.lit(i).alias("measure"), cents(F.col(c)).alias("units")) for i, c in enumerate(amounts)]
    return (
        df.select(*keys, F.inline(F.array(*entries)))
        .groupBy(*keys, "measure", "units")
        .agg(F.count("*").alias("n"))
    )


def _block(sizes: list[int]) -> Column:
    """Number of the block an amount is in; blocks keep the order of amounts. NULL goes to block 0."""
    block = F.lit(0).cast("bigint")
    for i, size in enumerate(sizes):
        block = F.when(F.col("measure") == i, F.expr(f"units div {size}")).otherwise(block)
    return F.coalesce(block, F.lit(0).cast("bigint"))


def block_sums(counts: DataFrame, keys: list[str], amounts: dict[str, int]) -> DataFrame:
    """(keys, measure, block, nb_rows, in_block, total): counts added up by block of amounts."""
    return _block_sums(_blocked(counts, amounts), keys, _cents_sum())


def _blocked(counts: DataFrame, amounts: dict[str, int]) -> DataFrame:
    return counts.withColumn("block", _block(list(amounts.values()))).withColumn(
        "valid", F.when(F.col("units").isNotNull(), F.col("n")).otherwise(F.lit(0))
    )


def amount_stats(
    counts: DataFrame,
    keys: list[str],
    amounts: dict[str, int],
    members: DataFrame | None = None,
    sums: DataFrame | None = None,
) -> DataFrame:
    """One row per group: ``nb_rows`` and, per amount, ``<name>_mean`` and ``<name>_median``.

    ``counts`` come from ``amount_counts``; ``amounts`` gives the block size of each, in the same order.
    The groups are the keys themselves, or with ``members`` (key columns, group columns) every group a key is
    listed under; a key that is not listed drops out. Keys and groups must not be NULL.

    With ``sums``, the ``block_sums`` of the counts, only amounts of middle blocks are shuffled; the counts may then
    have several rows for an amount, which are added up.
    """
    # Both readers of the counts take the same columns and rows, so Spark shuffles them once.
    blocked = _blocked(counts, amounts)
    groups, per_block = keys, _block_sums(blocked, keys, _cents_sum()) if sums is None else sums
    if members is not None:
        on = [c for c in keys if c in members.columns]
        groups = [c for c in keys if c not in on] + [c for c in members.columns if c not in on]
        per_block = _block_sums(per_block.join(members, on), groups, F.sum("total"), "nb_rows", "in_block")

    blocks = _middle_blocks(per_block, [*groups, "measure"])
    if members is not None:
        blocks = blocks.join(members, [c for c in groups if c in members.columns])
    inside = blocked.join(blocks, [*keys, "measure", "block"])
    if members is not None or sums is not None:
        inside = inside.groupBy(*groups, "measure", "block", "units").agg(
            F.sum("valid").alias("valid"), *[F.max(name).alias(name) for name in CARRIED]
        )
    if sums is not None:
        # Amounts whose counts add up to nothing would pass for the one before them.
        inside = inside.where((F.col("valid") > 0) | (F.col("nb_values") == 0))
    hits = _middle_amounts(inside, [*groups, "measure"])
    picked = {"nb_values": F.max, "total": F.max, "lower": F.min, "upper": F.max}
    figures = hits.groupBy(*groups).agg(
        F.max("nb_rows").alias("nb_rows"),
        *[
            pick(F.when(F.col("measure") == i, F.col(value))).alias(f"{name}_{value}")
            for i, name in enumerate(amounts)
            for value, pick in picked.items()
        ],
    )
    return figures.select(
        *groups,
        "nb_rows",
        *[_mean(F.col(f"{name}_total"), F.col(f"{name}_nb_values")).alias(f"{name}_mean") for name in amounts],
        *[
            ((F.col(f"{name}_lower") + F.col(f"{name}_upper")) / F.lit(200.0)).alias(f"{name}_median")
            for name in amounts
        ],
    )


def amount_means(df: DataFrame, keys: list[str], amount: str, members: DataFrame | None = None) -> DataFrame:
    """Mean of one amount per group as ``<amount>_mean``: a sum and a count per key, added up for ``members``."""
    sums = df.groupBy(*keys).agg(F.sum(cents(F.col(amount)).cast("decimal(18,0)")).alias("_total"), F.count(amount).alias("_n"))
    return _means(sums, keys, amount, members)


def means_of_sums(sums: DataFrame, keys: list[str], measure: int, amount: str, members: DataFrame | None = None) -> DataFrame:
    """``amount_means`` of the measure with this number, from ``block_sums``."""
    of_key = sums.where(F.col("measure") == measure).groupBy(*keys)
    return _means(of_key.agg(F.sum("total").alias("_total"), F.sum("in_block").alias("_n")), keys, amount, members)


def _means(sums: DataFrame, keys: list[str], amount: str, members: DataFrame | None) -> DataFrame:
    groups = keys
    if members is not None:
        on = [c for c in keys if c in members.columns]
        groups = [c for c in keys if c not in on] + [c for c in members.columns if c not in on]
        sums = sums.join(members, on).groupBy(*groups).agg(F.sum("_total").alias("_total"), F.sum("_n").alias("_n"))
    return sums.select(*groups, _mean(F.col("_total").cast("decimal(38,0)"), F.col("_n")).alias(f"{amount}_mean"))


def _cents_sum() -> Column:
    return F.sum(F.col("units").cast("decimal(18,0)") * F.col("n").cast("decimal(18,0)"))


def _block_sums(df: DataFrame, keys: list[str], total: Column, rows: str = "n", valid: str = "valid") -> DataFrame:
    return df.groupBy(*keys, "measure", "block").agg(
        F.sum(rows).alias("nb_rows"), F.sum(valid).alias("in_block"), total.cast("decimal(38,0)").alias("total")
    )


def _middle_blocks(per_block: DataFrame, group: list[str]) -> DataFrame:
    """The block or two with the middle ranks of each group, these ranks counted from the block's start."""
    whole = W.partitionBy(*group)
    running = F.sum("in_block").over(whole.orderBy("block"))
    ranked = per_block.select(
        *group,
        "block",
        (running - F.col("in_block")).alias("before"),
        running.alias("upto"),
        *[
            F.sum(value).over(whole).alias(name)
            for name, value in {"nb_rows": "nb_rows", "nb_values": "in_block", "total": "total"}.items()
        ],
    )
    lower, upper = F.expr("(nb_values + 1) div 2"), F.expr("nb_values div 2 + 1")
    return ranked.where((F.col("before") < upper) & (F.col("upto") >= lower)).select(
        *group,
        "block",
        (lower - F.col("before")).alias("from_rank"),
        (upper - F.col("before")).alias("to_rank"),
        "nb_rows",
        "nb_values",
        "total",
    )


def _middle_amounts(inside: DataFrame, group: list[str]) -> DataFrame:
    """The middle amounts of each group as ``lower`` and ``upper``; a group without amounts keeps a row."""
    upto = F.sum("valid").over(W.partitionBy(*group, "block").orderBy("units"))
    middle = (
        F.col("units").isNotNull()
        & (F.col("upto") - F.col("valid") < F.col("to_rank"))
        & (F.col("upto") >= F.col("from_rank"))
    )
    return (
        inside.withColumn("upto", upto)
        .where(middle | (F.col("nb_values") == 0))
        .withColumn("lower", F.col("units"))
        .withColumn("upper", F.col("units"))
    )


def _mean(total: Column, number: Column) -> Column:
    """Mean of cents as an amount with six decimals, rounded half up; NULL for no values.

    Holds for 10^12 rows of 10^12 cents and for as many as 10^18 rows; the quotient keeps 14 decimals.
    """
    euros = (total.cast("decimal(26,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(26,2)")
    return F.try_divide(euros, number.cast("decimal(18,0)")).cast("decimal(16,6)")
