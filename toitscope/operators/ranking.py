"""First rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LANES = 32


def first_n_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int | None, lanes: int = LANES
) -> DataFrame:
    """First ``n`` rows of each group in a total ``order``; all rows when ``n`` is ``None`` or 0.

    Without ``keys`` the whole frame is one group.

    A group of any size never meets in one task: each input task keeps at most ``n`` rows of a group,
    ``lanes`` tasks cut those down, and the last step sees at most ``lanes * n`` rows of a group.
    """
    if not n:
        return df
    laned = df.withColumn("_lane", F.spark_partition_id() % lanes)
    near = W.partitionBy(*keys, "_lane").orderBy(*order)
    last = W.partitionBy(*keys).orderBy(*order)
    return (
        laned.withColumn("_place", F.row_number().over(near))
        .where(F.col("_place") <= n)
        .drop("_lane", "_place")
        .withColumn("_place", F.row_number().over(last))
        .where(F.col("_place") <= n)
        .drop("_place")
    )


def latest_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row with the greatest ``order`` of each key, NULLs of that row included.

    An aggregate, so every task sends on one row per key, however hot the key is.
    """
    rest = [name for name in df.columns if name not in keys]
    best = F.max_by(F.struct(*[F.col(f"`{name}`") for name in rest]), order).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
