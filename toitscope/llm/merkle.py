"""A Merkle tree over a dataset: a digest of every row, of every source and of the whole, with a proof for each row.

Nodes carry nested intervals. The rows of a source, sorted by id, are its leaves and have ranks; a node at level ``l``
covers the ranks of up to ``ARITY`` nodes of the level below, so the interval of a parent holds those of its children
and the bucket ``rank div ARITY^(l+1)`` names the only parent a node can have. Going up, the nodes of a bucket are
grouped (three of them at most); going down, families meet the proof of their parent by bucket and containment, and the
siblings of a child are what its own interval leaves of the parent's. The tables of the levels shrink by ``ARITY``
each, so all of them together are half as large again as the leaves. The roots of the sources are leaves of a second
tree of the same kind.

Ranks come from one sort by range: rows are numbered inside their partition, and partitions and the sources in them
get their first rank from a table with one row per partition and source. No source is gathered in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toitscope.llm.shared import staged

ARITY = 3
_IN_PARTITION = (1 << 33) - 1

_STEP = "struct<left:string,right:string>"


def measured(value: Column) -> Column:
    """The value as it is hashed: its length in UTF-8 and itself, or ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tampered(doc_id: Column) -> Column:
    """Rows whose text loses its line breaks before it is verified; a null id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 2 == 0


def _ranked(rows: DataFrame, source: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``first`` (rank among all), ``lo`` (the first rank of the row's source) and ``n`` (rows of it)."""
    by = [F.col(c).asc_nulls_first() for c in [source, *order]]
    laid = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = staged(laid.withColumn("_id", F.monotonically_increasing_id()), name)
    numbered = numbered.withColumn("_part", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND(F.lit(_IN_PARTITION)))
    # One row for each source of each partition, and then one for each partition.
    runs = staged(numbered.groupBy("_part", source).agg(F.min("_at").alias("_at"), F.count("*").alias("_rows")), f"{name}-runs")
    parts = runs.groupBy("_part").agg(F.sum("_rows").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("_part", before.alias("_before"))
    placed = runs.join(starts, "_part").withColumn("_first", F.col("_before") + F.col("_at"))
    whole = placed.groupBy(F.col(source).alias("_whole")).agg(F.min("_first").alias("lo"), F.sum("_rows").alias("n"))
    placed = placed.join(whole, F.col(source).eqNullSafe(F.col("_whole"))).select(
        F.col("_part").alias("_run_part"), F.col(source).alias("_run_source"), "_before", "lo", "n"
    )
    at = (F.col("_part") == F.col("_run_part")) & F.col(source).eqNullSafe(F.col("_run_source"))
    return numbered.join(placed, at).select(*rows.columns, (F.col("_before") + F.col("_at")).alias("first"), "lo", "n")


def _height(leaves: DataFrame, arity: int) -> int:
    """Levels above the leaves of the largest tree; one number reaches the driver."""
    most, height = leaves.agg(F.max("n")).first()[0] or 0, 0
    while arity**height < most:
        height += 1
    return height


def _families(nodes: DataFrame, level: int, arity: int, name: str) -> DataFrame:
    """Parents of ``nodes`` (of one level, in trees that go on) with the children they cover."""
    bucket = F.expr(f"(first - lo) div {arity ** (level + 1)}")
    children = F.array_sort(F.collect_list(F.struct("first", "last", "digest")))
    grouped = nodes.where(F.col("n") > arity**level).groupBy("lo", bucket.alias("bucket")).agg(
        F.first("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), children.alias("children")
    )
    return staged(grouped.withColumn("digest", digest(F.array_join("children.digest", ""))), f"{name}-{level}")


def _own_steps(arity: int) -> Column:
    """The siblings of ``child``: what its interval leaves of the parent's, to the left and to the right."""

    def beside(outside) -> Column:
        return F.array_join(F.transform(F.filter("children", outside), lambda c: c["digest"]), "")

    left = beside(lambda c: c["last"] <= F.col("child.first"))
    right = beside(lambda c: c["first"] >= F.col("child.last"))
    return F.array(F.struct(left.alias("left"), right.alias("right")))


def _grow(leaves: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Families of every level, and the top node of each tree: ``lo, first, last, n, digest``."""
    nodes = leaves.select("lo", "first", (F.col("first") + 1).alias("last"), "n", "digest")
    families, tops = [], [nodes.where("n = 1")]
    for level in range(_height(leaves, arity)):
        nodes = _families(nodes, level, arity, name)
        families.append(nodes)
        tops.append(nodes.where((F.col("n") > arity**level) & (F.col("n") <= arity ** (level + 1))).select(*tops[0].columns))
    return families, reduce(DataFrame.unionByName, tops)


def _attach(families: list[DataFrame], tops: DataFrame, arity: int, name: str) -> DataFrame:
    """``first`` and ``steps`` of every leaf: the siblings of it and its ancestors, from below, then its top's ``steps``."""
    out = None
    for level in reversed(range(len(families))):
        span = arity ** (level + 1)
        ended = tops.where((F.col("n") > arity**level) & (F.col("n") <= span)).select("lo", "first", "last", "steps")
        parents = ended if out is None else out.unionByName(ended)
        held = parents.select(
            F.col("lo").alias("p_lo"), F.expr(f"(first - lo) div {span}").alias("p_bucket"),
            F.col("first").alias("p_first"), F.col("last").alias("p_last"), F.col("steps").alias("above"),
        )
        family = families[level].select("lo", "bucket", "first", "last", "children")
        inside = (F.col("p_first") <= F.col("first")) & (F.col("last") <= F.col("p_last"))
        met = family.join(held, (F.col("lo") == F.col("p_lo")) & (F.col("bucket") == F.col("p_bucket")) & inside)
        spread = met.select("lo", "children", "above", F.explode("children").alias("child"))
        out = spread.select(
            "lo", F.col("child.first").alias("first"), F.col("child.last").alias("last"),
            F.concat(_own_steps(arity), "above").alias("steps"),
        )
        if level and level % 4 == 0:
            out = staged(out, f"{name}-proofs")
    alone = tops.where("n = 1").select("lo", "first", "last", "steps")
    return (alone if out is None else out.unionByName(alone)).select("first", "steps")


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("source", "lang", "n_chars", "text"),
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    arity: int = ARITY,
) -> DataFrame:
    """One row per document: ``doc_id, source, first, leaf, altered, subroot, root, steps``.

    ``leaf`` is the digest of the id and ``columns``, ``altered`` that of the row as ``tampered`` says it is met later,
    and ``steps`` lists from below what stands left and right of the row's ancestors, up to ``root``. The leaves of a
    source ascend by id; null ids come first, rows of one id by their digest, and equal rows have equal digests, so it
    does not matter which comes first. A null source is a source of its own and comes before all others; other
    columns of ``docs`` are not read, whatever their names. An empty table gives an empty one.
    """
    row = {name: F.col(name) for name in columns}
    cut = {**row, text_column: F.when(tampered(F.col(id_column)), F.replace(F.col(text_column), F.lit("\n"), F.lit(""))).otherwise(F.col(text_column))}
    leaf, altered = (digest(measured(F.col(id_column)), *[measured(r[c]) for c in columns]) for r in (row, cut))
    read = docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), leaf.alias("digest"), altered.alias("altered"))
    leaves = staged(_ranked(staged(read, "merkle-rows"), "source", ["doc_id", "digest"], "merkle-sorted"), "merkle-leaves")
    families, tops = _grow(leaves, arity, "merkle-level")
    # The second tree has one leaf for each source.
    crowns = staged(tops.select(F.lit(0).alias("crown"), F.col("lo").alias("at"), "first", "last", "n", "digest"), "merkle-tops")
    second = staged(_ranked(crowns.select("crown", "at", "digest"), "crown", ["at"], "merkle-sources"), "merkle-second")
    upper, peak = _grow(second, arity, "merkle-upper")
    root = peak.select("digest").first()
    no_steps = F.array().cast(f"array<{_STEP}>")
    above = _attach(upper, peak.withColumn("steps", no_steps), arity, "merkle-upper")
    sources = second.select("first", "at").join(above, "first").select("at", "steps")
    ends = staged(crowns.join(sources, "at").select(F.col("at").alias("lo"), "first", "last", "n", "steps"), "merkle-ends")
    proofs = _attach(families, ends, arity, "merkle")
    # All sources lie equally deep under the root, so a row's steps to its source are all but the last ones.
    inner = F.slice("steps", 1, F.size("steps") - len(upper))
    return leaves.join(proofs, "first").select(
        "doc_id", "source", "first", F.col("digest").alias("leaf"), "altered", folded("digest", inner).alias("subroot"),
        F.lit(root["digest"] if root else None).cast("string").alias("root"), "steps",
    )


def folded(leaf: str | Column, steps: str | Column) -> Column:
    """The root that a leaf and the siblings of its ancestors lead to."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    return F.aggregate(steps, start, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(steps: str | Column) -> Column:
    """One digest for all siblings, from below, left to right."""
    return digest(F.array_join(F.transform(steps, lambda step: F.concat(step["left"], step["right"])), ""))


def verified(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: every row checked against the root, as altered."""
    found = manifest(docs, **how).withColumn("folded_root", folded("altered", "steps"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest("steps").alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
