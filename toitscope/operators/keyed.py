"""Loading under a key: upsert, unique-key conflicts, multiset difference of deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toitscope.operators.ranking import latest_per_key

COPY_CHUNK = 1_000_000


class KeyConflict(ValueError):
    """A batch clashes with a unique key."""


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    update: list[str],
    fill: dict[str, Column] | None = None,
    keep_missing: bool = False,
    touch: dict[str, Column] | None = None,
) -> DataFrame:
    """``existing`` with the ``update`` columns replaced where ``incoming`` has the key, and new keys added.

    ``incoming`` holds each key once (fold it first). Columns outside ``update`` keep their stored value; a
    new key takes them from ``fill``, else NULL. With ``keep_missing`` a NULL that comes in leaves the stored value.
    ``touch`` gives columns their value wherever ``incoming`` has the key.
    """
    fill, touch = fill or {}, touch or {}
    old = existing.withColumn("_old", F.lit(True)).alias("old")
    new = incoming.select(*keys, *update).withColumn("_new", F.lit(True)).alias("new")

    def column(name: str) -> Column:
        stored = F.col(f"old.{name}") if name not in keys else None
        if name in keys:
            return F.col(name)
        if name in update:
            given = F.coalesce(F.col(f"new.{name}"), stored) if keep_missing else F.col(f"new.{name}")
            return F.when(F.col("_new"), given).otherwise(stored).alias(name)
        kept = F.when(F.col("_old"), stored).otherwise(fill.get(name, F.lit(None)))
        return (F.when(F.col("_new"), touch[name]).otherwise(kept) if name in touch else kept).alias(name)

    return old.join(new, keys, "full_outer").select(*[column(name) for name in existing.columns])


def key_conflicts(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, nb_incoming, already_stored): keys that a plain insert of ``incoming`` would break."""
    counted = incoming.groupBy(*keys).agg(F.count("*").alias("nb_incoming"))
    stored = existing.select(*keys).distinct().withColumn("_stored", F.lit(True))
    return (
        counted.join(stored, keys, "left")
        .select(*keys, "nb_incoming", F.coalesce("_stored", F.lit(False)).alias("already_stored"))
        .where((F.col("nb_incoming") > 1) | F.col("already_stored"))
    )


def insert_unique(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    on_conflict: str = "abort",
    order: Column | None = None,
) -> DataFrame:
    """The rows to add (``abort``, ``skip``) or the whole new table (``update``).

    ``skip`` keeps the first row of a key by ``order`` unless the key is stored; ``update`` lets the last win.
    """
    if on_conflict == "abort":
        clash = key_conflicts(existing, incoming, keys).head(1)
        if clash:
            raise KeyConflict(f"unique key {keys}: {clash[0].asDict()}")
        return incoming
    if order is None:
        raise ValueError("skip and update need a row order")
    placed = incoming.withColumn("_order", order)
    if on_conflict == "skip":
        rest = [name for name in incoming.columns if name not in keys]
        first = F.min_by(F.struct(*rest), F.col("_order")).alias("_first")
        folded = placed.groupBy(*keys).agg(first).select(*keys, "_first.*").select(*incoming.columns)
        return folded.join(existing.select(*keys), keys, "left_anti")
    if on_conflict == "update":
        folded = latest_per_key(placed, keys, F.col("_order")).drop("_order")
        update = [name for name in incoming.columns if name not in keys]
        return upsert(existing, folded, keys, update)
    raise ValueError(f"unknown policy {on_conflict}")


def not_yet_loaded(incoming: DataFrame, existing: DataFrame, columns: list[str], chunk: int = COPY_CHUNK) -> DataFrame:
    """Rows of ``incoming`` beyond those in ``existing``, copies counted (multiset difference).

    Copies travel as counts, so a row repeated any number of times is one record per task until the end, where
    its copies are dealt out in chunks and written by several tasks.
    """
    # NULLs group together, as they should here. Columns are cast so that both sides have one type.
    kinds = {f.name: f.dataType for f in existing.schema.fields}
    signed = incoming.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns], F.lit(1).alias("_sign")).unionAll(
        existing.select(*columns, F.lit(-1).alias("_sign"))
    )
    surplus = signed.groupBy(*columns).agg(F.sum("_sign").alias("_copies")).where(F.col("_copies") > 0)
    return deal_copies(surplus, columns, chunk)


def deal_copies(counted: DataFrame, columns: list[str], chunk: int = COPY_CHUNK) -> DataFrame:
    """Each row as often as its ``_copies`` says; the copies of one row are dealt out and written by several tasks."""
    parts = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_copies - 1) div {chunk}"))
    dealt = counted.select(*columns, "_copies", F.explode(parts).alias("_part")).repartition(*columns, "_part")
    size = F.least(F.lit(chunk).cast("bigint"), F.col("_copies") - F.col("_part") * chunk)
    return dealt.select(*columns, F.explode(F.sequence(F.lit(1), size.cast("int"))).alias("_copy")).drop("_copy")
