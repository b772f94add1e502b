"""Table constraints as row rules, foreign keys, cascade delete, narrowing to the stored types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toitscope.schemas import ALLOWED, MAX_LENGTH, TABLES


def narrowed(name: str, kind: T.DataType) -> Column:
    """Value in the stored type, rounded half up; NULL when it does not fit."""
    return F.col(name).try_cast(kind)


def row_rules(table: str, columns: list[str]) -> dict[str, Column]:
    """Rule code -> condition under which a row breaks it, for the columns at hand."""
    rules: dict[str, Column] = {}
    for spec in TABLES[table].fields:
        name = spec.name
        if name not in columns:
            continue
        if not spec.nullable:
            rules[f"{name}_null"] = F.col(name).isNull()
        if isinstance(spec.dataType, (T.DecimalType, T.IntegerType)):
            rules[f"{name}_range"] = F.col(name).isNotNull() & narrowed(name, spec.dataType).isNull()
        if name in MAX_LENGTH[table]:
            rules[f"{name}_length"] = F.char_length(name) > MAX_LENGTH[table][name]
        if name in ALLOWED.get(table, {}):
            rules[f"{name}_label"] = ~F.col(name).isin(ALLOWED[table][name])
    return rules


def with_violations(df: DataFrame, table: str) -> DataFrame:
    """Adds ``violations``: the codes of the rules a row breaks, empty for a good row."""
    rules = row_rules(table, df.columns)
    codes = [F.when(broken, F.lit(code)) for code, broken in rules.items()]
    return df.withColumn("violations", F.array_compact(F.array(*codes)))


def violation_counts(checked: DataFrame) -> DataFrame:
    """(violation, nb_rows) over rows with ``violations``."""
    return (
        checked.select(F.explode("violations").alias("violation"))
        .groupBy("violation")
        .agg(F.count("*").alias("nb_rows"))
    )


def narrow(df: DataFrame, table: str) -> DataFrame:
    """Columns of the target table present in ``df``, in its order and types."""
    present = [spec for spec in TABLES[table].fields if spec.name in df.columns]
    return df.select(*[narrowed(spec.name, spec.dataType).alias(spec.name) for spec in present])


def loadable(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key exists in the parent."""
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.join(known, child_key, "left_semi").select(*child.columns)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is missing from the parent."""
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.join(known, child_key, "left_anti").select(*child.columns)


def mark_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Adds ``_orphan``; ``parent_key`` is unique, so no row is doubled."""
    known = parent.select(F.col(parent_key).alias(child_key), F.lit(True).alias("_known"))
    joined = child.join(known, child_key, "left")
    return joined.select(*child.columns, F.col("_known").isNull().alias("_orphan"))


def cascade_delete(child: DataFrame, deleted: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """What remains of a child table once the given parents are gone."""
    return orphans(child, deleted, child_key, parent_key)
