"""Near-duplicate vectors by an exact metric range join.

Vectors of length one are as far apart as their cosine says: cosine ``c`` is distance ``sqrt(2 - 2c)``. Pivots drawn
from the data cut each label into cells of nearest pivots. By the triangle inequality a vector within the range of
some member of a cell is at most twice the range farther from that cell's pivot than from its own, and at most the
range beyond the cell's farthest member; in Euclidean space it must also lie within the range of the plane half way
between the two pivots. A vector is copied to the cells that meet all three, and each cell is joined by itself, so
every link is found where the cell of either end meets it.

A cell is joined in blocks: its own members against everything in it, a block of each at a time, whatever the size of
the cell. A block sends how many links each member has and one edge for each member that joins the block's members
into components, never the linked pairs. Vectors with equal components travel as one with their number, and copies of
one another are linked through it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toitscope.llm.components import components
from toitscope.llm.shared import staged

COSINE = 0.98
CELL = 2048
MOST_PIVOTS = 512
BLOCK = 2048
SLACK = 1e-9


def rows_of(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows, each scaled by a power of two so that no square is out of range."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    x = np.asarray(vectors.flatten()).reshape(len(vectors), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _square(x: np.ndarray) -> np.ndarray:
    return np.clip(x, 0, None)


def assign(pivots: np.ndarray, reach: float):
    """A task that names each vector's own cell and its distance to that cell's pivot, then the cells it may border.

    ``pivots`` are of length one. Bordering cells pass the triangle inequality and the half-way plane; the farthest
    member of the cell is known only after all are assigned.
    """
    apart = np.sqrt(_square(2 - 2 * pivots @ pivots.T))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            square = _square(2 - 2 * unit(rows_of(batch.column(2))) @ pivots.T)
            distance = np.sqrt(square)
            own = distance.argmin(axis=1)
            row = np.arange(len(own))
            near = distance <= distance[row, own][:, None] + 2 * reach + SLACK
            between = apart[own]
            plane = (square - square[row, own][:, None]) <= 2 * between * (reach + SLACK)
            near &= plane | (between < 1e-6)
            near[row, own] = True
            at, cell = np.nonzero(near)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    batch.column(1).take(pa.array(at)),
                    batch.column(2).take(pa.array(at)),
                    batch.column(3).take(pa.array(at)),
                    pa.array(cell.astype(np.int32)),
                    pa.array(distance[at, cell]),
                    pa.array(own[at] == cell),
                ],
                names=["node", "label", "vector", "n", "cell", "away", "own"],
            )

    return cells


def linked_blocks(threshold: float):
    """A task that joins one block of a cell's members with one block of all that the cell holds."""

    def join(table: pa.Table) -> pa.Table:
        members, others = (table.filter(pc.equal(table.column("side"), k)) for k in (0, 1))
        links: list = []
        counts: list = []
        edges: list = []
        if members.num_rows and others.num_rows:
            mine, theirs = members.column("node").to_numpy(), others.column("node").to_numpy()
            weight = others.column("n").to_numpy()
            x, y = rows_of(members.column("vector")), rows_of(others.column("vector"))
            x_long, y_long = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
            for a in range(0, len(x), 256):
                cosine = (x[a : a + 256] @ y.T) / (x_long[a : a + 256, None] * y_long)
                hit = (cosine >= threshold) & (mine[a : a + 256, None] != theirs)
                found = np.flatnonzero(hit.any(axis=1))
                for i in found.tolist():
                    ends = np.flatnonzero(hit[i])
                    links.append(int(mine[a + i]))
                    counts.append(int(weight[ends].sum()))
                    edges.append(ends)
        out = _spanning(links, edges, theirs) if links else []
        return pa.table(
            {
                "node": pa.array(links + [a for a, _ in out], pa.int64()),
                "links": pa.array(counts + [0] * len(out), pa.int64()),
                "other": pa.array([None] * len(links) + [b for _, b in out], pa.int64()),
            }
        )

    return join


def _spanning(nodes: list[int], ends: list[np.ndarray], theirs: np.ndarray) -> list[tuple[int, int]]:
    """A star for each component of the links found in a block: as many edges as nodes at most."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for node, hit in zip(nodes, ends, strict=True):
        for other in theirs[hit].tolist():
            a, b = find(node), find(other)
            if a != b:
                root[max(a, b)] = min(a, b)
    return [(x, find(x)) for x in list(root) if find(x) != x]


def near_vectors(
    vectors: DataFrame,
    threshold: float = COSINE,
    cell: int = CELL,
    most_pivots: int = MOST_PIVOTS,
    block: int = BLOCK,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors with equal labels link when their cosine, in double precision, reaches ``threshold`` (above 0). A vector
    that is null, empty or zero or holds a null or a component that is not finite, and one whose label is null, links
    with nothing; vectors of different lengths do not link. Rows with equal ids and vectors count as copies of each
    other. A null id has a component of its own kind: its smallest id is that of the others, or null. Other columns
    are not read; an empty table gives none.

    ``cell`` is how many vectors of a label a pivot is meant for and ``most_pivots`` how many pivots there are at
    most; the bound keeps what is broadcast small, and cells that grow beyond it are joined in more blocks.
    """
    spark = vectors.sparkSession
    read = vectors.select(
        F.col(id_column).alias("vec_id"),
        F.col(label_column).alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("label").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    rows = staged(read.withColumn("usable", F.coalesce(usable, F.lit(False))), "vectors")
    # Adding 0.0 makes -0.0 and 0.0 one value.
    good = rows.where("usable").withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    classes = staged(
        good.groupBy("label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id")), "vector-classes"
    ).withColumn("node", F.monotonically_increasing_id())
    classes = staged(classes, "vector-nodes")
    edges, links = _links(classes, threshold, cell, most_pivots, block)
    root = staged(components(edges), "vector-components")
    named = classes.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = staged(named.groupBy("root").agg(F.min("least_id").alias("component_id")), "vector-least")
    told = staged(
        named.join(least, "root")
        .join(links, "node", "left")
        .select("label", "vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")),
        "vector-told",
    )
    linked = good.join(told, ["label", "vector"])
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = linked.select("vec_id", F.col("n_links").cast("bigint"), "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(classes: DataFrame, threshold: float, cell: int, most_pivots: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Edges that join classes into components, and the number of vectors linked with each class."""
    spark = classes.sparkSession
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    widths = [row["width"] for row in classes.select(F.size("vector").alias("width")).distinct().collect()]
    kind = T.StructType(
        [
            T.StructField("node", T.LongType()),
            T.StructField("label", classes.schema["label"].dataType),
            T.StructField("vector", T.ArrayType(T.DoubleType())),
            T.StructField("n", T.LongType()),
            T.StructField("cell", T.IntegerType()),
            T.StructField("away", T.DoubleType()),
            T.StructField("own", T.BooleanType()),
        ]
    )
    blocks, spanning = [], []
    for width in widths:
        some = classes.where(F.size("vector") == width).select("node", "label", "vector", "n")
        largest = some.groupBy("label").count().agg(F.max("count")).first()[0]
        wanted = min(most_pivots, -(-largest // cell))
        drawn = some.orderBy(F.xxhash64("vector"), "node").limit(wanted).select("vector").collect()
        pivots = rows_of(pa.array([row["vector"] for row in drawn], pa.list_(pa.float64())))
        dealt = staged(some.mapInArrow(assign(unit(pivots), reach), kind), "vector-cells")
        far = dealt.where("own").groupBy("label", "cell").agg(F.max("away").alias("radius"), F.count("*").alias("own_n"))
        held = dealt.groupBy("label", "cell").agg(F.count("*").alias("all_n"))
        sizes = staged(far.join(held, ["label", "cell"]), "vector-cell-sizes")
        inside = dealt.join(sizes, ["label", "cell"]).where(F.col("own") | (F.col("away") <= F.col("radius") + reach + SLACK))
        spread = lambda n: F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.ceil(F.col(n) / block))).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), (F.greatest(F.lit(1), F.ceil(F.col(n) / block)) - 1).cast("int")))
        columns = ["label", "cell", "mine", "theirs", "side", "node", "vector", "n"]
        members = inside.where("own").withColumn("mine", spread("own_n")).withColumn("theirs", every("all_n"))
        others = inside.withColumn("theirs", spread("all_n")).withColumn("mine", every("own_n"))
        both = members.withColumn("side", F.lit(0)).select(columns).union(others.withColumn("side", F.lit(1)).select(columns))
        joined = both.groupBy("label", "cell", "mine", "theirs").applyInArrow(
            linked_blocks(threshold), "node long, links long, other long"
        )
        blocks.append(staged(joined, "vector-links"))
    if not blocks:
        blocks = [spark.createDataFrame([], "node long, links long, other long")]
    found = blocks[0]
    for more in blocks[1:]:
        found = found.union(more)
    edges = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    links = staged(found.where("other is null").groupBy("node").agg(F.sum("links").alias("links")), "vector-counts")
    return edges, links
