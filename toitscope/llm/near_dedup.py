"""Near-duplicate texts by an LSH forest over MinHash signatures.

A document is the set of its word shingles, as 64-bit hashes; texts with equal sets form a class and travel as one.
Each tree of the forest sorts all classes by its own order of signature slots. Neighbours in a sorted order share the
longest prefixes that anything shares there, so each class is paired with the few before it as long as they share
the least depth: where many classes are alike the neighbours agree to a greater depth, where few are, a short prefix
will do. Orders are dealt by range with the class as last key, so no task holds a region whole, and the first and
last rows of each range meet in one small extra pass.

Pairs whose signatures are far from similar enough go. Of the rest, each class confirms the most similar ones on full
sets. Neighbours are few by design, and so are those that are confirmed, so links may hide where many classes are
alike. There the exact way takes over: what the neighbours connect is a region, and in each region that is not one
component by now, all classes of different components are compared on their full sets, a block against a block at a
time, without writing the pairs out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toitscope.llm.components import components
from toitscope.llm.shared import small_batches, staged, text_of

SHINGLE_WORDS = 5
PERCENT = 80
SLOTS = 64
TREES = 16
DEPTH = 8
LEAST_DEPTH = 3
NEIGHBOURS = 2
CHUNK = 1 << 20
#: Pairs go when their signatures agree in this much less than the links ask for: over five standard deviations.
MARGIN = 0.25
FOREMOST = 3
BLOCK = 1024

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BREAK = np.zeros(256, bool)
_BREAK[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TIMES = _RANDOM.integers(0, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(0, 1 << 63, SLOTS, dtype=np.uint64)
_ORDERS = [_RANDOM.permutation(SLOTS)[:DEPTH].tolist() for _ in range(TREES)]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the number of words up to the end of each text."""
    raw = [text.encode("utf-8", "surrogatepass") + b" " for text in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    blank = _BREAK[data]
    inside = ~blank
    start = np.flatnonzero(inside & np.concatenate([[True], blank[:-1]]))
    end = np.flatnonzero(blank & np.concatenate([[False], inside[:-1]]))
    powers = np.cumprod(np.full(len(data), _BASE, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * powers)])
    back = np.cumprod(np.full(len(data), _BASE_INVERSE, np.uint64))
    words = mixed((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    ends = np.searchsorted(start, np.cumsum([len(r) for r in raw]), side="left")
    return words, ends


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without is none."""
    out: list[np.ndarray] = []
    group: list[str] = []
    held = 0
    for i, text in enumerate(texts):
        group.append(text)
        held += len(text)
        if held < CHUNK and i + 1 < len(texts):
            continue
        words, ends = word_hashes(group)
        n = len(words) - size + 1
        runs = np.full(max(n, 0), size, np.uint64)
        for j in range(size if n > 0 else 0):
            runs += words[j : j + n] * _WORD[j]
        runs = mixed(runs)
        first = 0
        for last in ends.tolist():
            if last - first >= size:
                out.append(np.unique(runs[first : last - size + 1]))
            elif last > first:
                short = np.uint64(last - first) + (words[first:last] * _WORD[: last - first]).sum(dtype=np.uint64)
                out.append(mixed(np.array([short], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            first = last
        group, held = [], 0
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The least hash of each (not empty) set under each slot's function."""
    out = np.zeros((len(sets), SLOTS), np.uint32)
    if sets:
        values = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        for slot in range(SLOTS):
            out[:, slot] = np.minimum.reduceat((values * _TIMES[slot] + _PLUS[slot]) >> np.uint64(32), starts)
    return out


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketches(size: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(2).to_pylist(), size)
            filled = [s for s in sets if len(s)]
            slots = iter(signatures(filled).astype(">u4"))
            rows = [(digest(s), next(slots).tobytes()) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([r[0] for r in rows], pa.binary()),
                    pa.array([r[1] for r in rows], pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "digest", "signature"],
            )

    return sketch


def _full_sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shingle_sets(batch.column(1).to_pylist(), size)
            same = [i for i, (s, d) in enumerate(zip(found, batch.column(0).to_pylist())) if digest(s) == d]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(same, pa.int64())),
                    pa.array([found[i].view(np.int64) for i in same], pa.list_(pa.int64())),
                ],
                names=["digest", "shingles"],
            )

    return sets


def _neighbours(last_pass: bool):
    """Pairs of rows of a sorted order that share the least depth, and the rows at either end of the range."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_trees, tail_labels, tail_nodes = np.zeros(0, np.int64), np.zeros((0, DEPTH), np.uint32), []
        begun = 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            trees = np.concatenate([tail_trees, batch.column(0).to_numpy()])
            own = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").astype(np.uint32).reshape(n, DEPTH)
            labels = np.concatenate([tail_labels, own])
            nodes = tail_nodes + batch.column(2).to_pylist()
            old = len(tail_nodes)
            a, b, depth = [], [], []
            for back in range(1, NEIGHBOURS + 1):
                at = np.arange(max(old, back), len(nodes))
                same = np.logical_and.accumulate(labels[at] == labels[at - back], axis=1).sum(axis=1)
                same[trees[at] != trees[at - back]] = 0
                for i in np.flatnonzero(same >= LEAST_DEPTH).tolist():
                    x, y = nodes[at[i]], nodes[at[i] - back]
                    if x != y:
                        a.append(min(x, y))
                        b.append(max(x, y))
                        depth.append(int(same[i]))
            yield rows(a, b, depth)
            if not last_pass and begun < NEIGHBOURS:
                ends = range(old, min(len(nodes), old + NEIGHBOURS - begun))
                yield ends_rows(trees, labels, nodes, ends)
                begun += len(ends)
            tail_trees, tail_labels, tail_nodes = trees[-NEIGHBOURS:], labels[-NEIGHBOURS:], nodes[-NEIGHBOURS:]
        if not last_pass and tail_nodes:
            yield ends_rows(tail_trees, tail_labels, tail_nodes, range(len(tail_nodes)))

    def rows(a: list, b: list, depth: list) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.binary())
        return pa.RecordBatch.from_arrays(
            [none[0], none[1], pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(depth, pa.int64())], names=names
        )

    def ends_rows(trees, labels, nodes: list, some: range) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(trees[i]) for i in some], pa.int64()),
                pa.array([labels[i].astype(">u4").tobytes() for i in some], pa.binary()),
                pa.array([nodes[i] for i in some], pa.binary()),
                pa.nulls(len(some), pa.binary()),
                pa.nulls(len(some), pa.int64()),
            ],
            names=names,
        )

    names = ["tree", "label", "a", "b", "depth"]
    return pairs


PAIRS = "tree bigint, label binary, a binary, b binary, depth bigint"


def candidates(classes: DataFrame) -> DataFrame:
    """Pairs of classes that are neighbours in some order: ``a, b`` and the depths they share, summed, as ``depth``."""
    labels = [
        F.struct(
            F.lit(t).cast("bigint").alias("tree"),
            F.concat(*[F.substring("signature", 4 * slot + 1, 4) for slot in order]).alias("label"),
        )
        for t, order in enumerate(_ORDERS)
    ]
    orders = classes.select(F.explode(F.array(*labels)).alias("at"), "digest").select("at.tree", "at.label", "digest")
    keys = ["tree", "label", "digest"]
    found = staged(
        orders.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_neighbours(False), PAIRS), "forest"
    )
    # Two rows from either end of each range: as many as there are partitions, not rows.
    ends = found.where("tree is not null").select("tree", "label", F.col("a").alias("digest"))
    across = ends.distinct().coalesce(1).sortWithinPartitions(*keys).mapInArrow(_neighbours(True), PAIRS)
    pairs = found.where("tree is null").select("a", "b", "depth").union(across.select("a", "b", "depth"))
    return staged(pairs.groupBy("a", "b").agg(F.sum("depth").alias("depth")), "forest-pairs")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets have at least ``percent`` of their union in common."""
    left = pairs.join(sets.select(F.col("digest").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("digest").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y")).cast("bigint")
    union = F.size("x") + F.size("y") - shared
    return both.where(100 * shared >= percent * union).select("a", "b")


def likely(pairs: DataFrame, classes: DataFrame, floor: float) -> DataFrame:
    """The pairs whose signatures agree in at least ``floor`` of their slots: ``a, b, alike``."""

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u4").reshape(n, SLOTS) for c in (2, 3))
            alike = (x == y).sum(axis=1)
            near = pa.array(np.flatnonzero(alike >= floor * SLOTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(near), batch.column(1).take(near), pa.array(alike.astype(np.int64)).take(near)],
                names=["a", "b", "alike"],
            )

    left = pairs.select("a", "b").join(classes.select(F.col("digest").alias("a"), F.col("signature").alias("x")), "a")
    both = left.join(classes.select(F.col("digest").alias("b"), F.col("signature").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(agreeing, "a binary, b binary, alike bigint")


def foremost(pairs: DataFrame, n: int = FOREMOST) -> DataFrame:
    """The pairs that are among the ``n`` most alike of either end; no class has more than a few to choose from."""
    ends = pairs.select("a", "b", "alike").union(pairs.select("b", "a", "alike"))
    ranked = ends.withColumn("place", F.row_number().over(W.partitionBy("a").orderBy(F.desc("alike"), "b")))
    return ranked.where(F.col("place") <= n).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _compared(percent: int):
    """A task that compares the full sets of two blocks of a region across components."""

    def compare(table: pa.Table) -> pa.Table:
        nodes, roots = table.column("node").to_pylist(), table.column("root").to_pylist()
        sets = table.column("shingles").combine_chunks()
        values, starts = np.asarray(sets.flatten()), np.asarray(sets.offsets) - sets.offsets[0].as_py()
        size = np.diff(starts)
        side = table.column("side").to_numpy()
        mine, theirs = (range(len(nodes)),) * 2 if (side == 2).all() else (np.flatnonzero(side == k).tolist() for k in (0, 1))
        top: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            while top.setdefault(x, x) != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        # Which of the other block have each shingle: their places, one run for each shingle in order.
        owner = np.repeat(np.arange(len(nodes)), size)
        other = np.isin(owner, np.array(theirs, np.int64))
        order = np.argsort(values[other], kind="stable")
        keys, owners = values[other][order], owner[other][order]
        out = []
        for i in mine:
            own = values[starts[i] : starts[i + 1]]
            first, last = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            runs = last - first
            at = np.repeat(first - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + np.arange(runs.sum())
            shared = np.bincount(owners[at], minlength=len(nodes))
            near = np.flatnonzero((shared > 0) & (100 * shared >= percent * (size[i] + size - shared)))
            for j in near.tolist():
                a, b = find(roots[i]), find(roots[j])
                if a != b:
                    top[max(a, b)] = min(a, b)
                    out.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    return compare


def compared_regions(pairs: DataFrame, root: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Edges between different components of the regions that ``pairs`` connect, from comparing all across.

    The classes of a region's largest component need no comparison with each other: they meet blocks of the others
    only. So does each of the others, and all others meet among themselves.
    """
    region = components(pairs.select("a", "b"))
    members = region.select("node", F.col("root").alias("region")).join(root, "node", "left")
    members = staged(members.withColumn("root", F.coalesce("root", "node")), "near-members")
    parts = members.groupBy("region", "root").agg(F.count("*").alias("n"))
    sizes = staged(
        parts.groupBy("region")
        .agg(F.max(F.struct("n", "root")).alias("largest"), F.sum("n").alias("all_n"), F.count("*").alias("parts"))
        # Two classes are one pair, which has been tried.
        .where("parts > 1 AND all_n > 2")
        .select("region", F.col("largest.root").alias("main"), F.col("largest.n").alias("main_n"), (F.col("all_n") - F.col("largest.n")).alias("rest_n")),
        "near-regions",
    )
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / block)).cast("int")
    every = lambda n: F.sequence(F.lit(0), blocks(n) - 1)
    own = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    placed = members.join(sizes, "region").withColumn("is_main", F.col("root") == F.col("main"))
    placed = placed.withColumn("own", F.when(F.col("is_main"), own("main_n")).otherwise(own("rest_n")))
    entry = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))
    here = F.col("own")
    against_main = F.transform(every("main_n"), lambda y: entry("main", here, y, F.lit(0)))
    from_main = F.transform(every("rest_n"), lambda x: entry("main", x, here, F.lit(1)))
    among = F.transform(
        every("rest_n"),
        lambda x: entry("rest", F.least(here, x), F.greatest(here, x), F.when(x == here, 2).when(here < x, 0).otherwise(1)),
    )
    met = F.when(F.col("is_main"), from_main).otherwise(F.concat(against_main, among))
    dealt = placed.select("region", "node", "root", F.explode(met).alias("at")).select("region", "at.*", "node", "root")
    filled = dealt.join(sets.select(F.col("digest").alias("node"), "shingles"), "node")
    return filled.groupBy("region", "kind", "i", "j").applyInArrow(_compared(percent), "a binary, b binary")


def near_texts(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept`` and ``text_hash``.

    Letters A-Z count as lower case and words end at U+0020 and U+0009 to U+000D. Documents link when their shingle
    sets have ``percent`` or more of their union in common; ``component_id`` is the least id reachable by links.
    Texts of fewer words than a shingle are one shingle; null and empty texts and those without words link with
    nothing. Rows with equal ids share a component only if their texts link; a null id counts after every other and
    is a component's id only if it has no other. Other columns are not read; an empty table gives none.
    """
    small_batches(docs.sparkSession)
    read = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )
    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("text_hash", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("signature", T.BinaryType()),
        ]
    )
    rows = staged(read.select("doc_id", "text_hash", "text").mapInArrow(_sketches(shingle_words), schema), "sketches")
    some_row = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("some")
    classes = staged(
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("signature").alias("signature"), some_row)
        .select("digest", "signature", "some.doc_id", "some.text_hash"),
        "shingle-classes",
    )
    pairs = staged(likely(candidates(classes), classes, percent / 100 - MARGIN), "near-likely")
    met = pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
    wanted = staged(
        met.join(classes, "digest").select(
            "digest", F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash")
        ),
        "near-wanted",
    )
    # Merged at every size: texts move once, in proportion to the corpus, and a hot row is split.
    texts = read.join(wanted.hint("merge"), (F.col("text_hash") == F.col("own_hash")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
    sets = staged(
        # One text of each class: a task sends each of its classes once, however many copies it has.
        texts.groupBy("digest").agg(F.first("text").alias("text"))
        .mapInArrow(_full_sets(shingle_words), "digest binary, shingles array<bigint>"),
        "near-sets",
    )
    edges = staged(confirmed(foremost(pairs), sets, percent), "near-found")
    root = staged(components(edges), "near-roots")
    more = staged(compared_regions(pairs, root, sets, percent), "near-regions-found")
    if not more.isEmpty():
        root = staged(components(edges.union(more)), "near-roots")
    named = classes.join(root, F.col("digest") == F.col("node"), "left").select(
        "digest", F.coalesce("root", "digest").alias("root"), "doc_id"
    )
    least = staged(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "near-least")
    told = staged(named.join(least, "root").select("digest", "root", "component_id"), "near-components")
    out = rows.select("doc_id", "n_shingles", "digest", "text_hash").join(told, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_hash",
        "root",
    )


def keep_one(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component of near copies.

    The least id stays, a null id after all others. Texts without words all stay. Rows that agree in id and text are
    one row of their component.
    """
    found = staged(
        near_texts(docs, shingle_words, percent, id_column, text_column)
        .where("root is not null")
        .groupBy("root", "doc_id", "text_hash")
        .agg(F.count("*").alias("n")),
        "near-decisions",
    )
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    stays = staged(found.groupBy("root").agg(F.min(own).alias("stays")), "near-stays")
    judged = found.join(stays, "root").withColumn("is_it", own.eqNullSafe(F.col("stays")))
    row = [F.col("doc_id").alias("near_id"), F.col("text_hash").alias("near_hash")]
    gone = staged(judged.where("not is_it").select(*row), "near-gone")
    at_row = (F.xxhash64(text_of(text_column)) == F.col("near_hash")) & F.col(id_column).eqNullSafe(F.col("near_id"))
    kept = docs.join(gone.hint("merge"), at_row, "left_anti")
    repeated = staged(judged.where("is_it and n > 1").select(*row), "near-repeated")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, at_row, "left_anti")
    return once.unionByName(kept.join(repeated, at_row, "left_semi").dropDuplicates([id_column, text_column]))
