"""Ranked lexical search: an inverted index in shards of documents, searched by Block-Max MaxScore.

Index. Documents become shards where they are read: a task numbers the terms and documents of a few million words and
sorts them into posting lists, so nothing is shuffled. A list is cut into blocks of 128 postings, compressed by
differences and variable-length bytes. Beside each block stand its last document and its skyline: the pairs of term
frequency and document length that no other posting of the block beats in both. A score falls with length and rises
with frequency, so the best of the skyline is the exact maximum of the block, whatever the corpus' averages turn out
to be, and no posting has to be read for it.

Search. The lists of an item are ordered by their greatest score in the shard. Those that together stay below the score
of the item's k-th document so far are not essential: a document found in them alone cannot enter. Candidates come from
the essential lists; what the blocks of the others could add at most rejects a candidate before a block is decompressed.
A task goes through its shards one after the other and keeps one heap per item, so later shards are met with the
thresholds of earlier ones; the heaps of all tasks are merged at the end. Equal scores stay candidates, as the smaller
id wins.

Items are searched in blocks of bounded size, which is what reaches the driver and is broadcast.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from toitscope.llm.shared import small_batches, staged, text_of

SHARD_WORDS = 4_000_000
BLOCK_POSTINGS = 128
#: Terms of the items that are searched together.
BLOCK_TERMS = 200_000
SHARDS_PER_TASK = 4
TOP = 50
#: Documents of a shard that are looked at before the first threshold is set; each further range is larger by GROWTH.
FIRST_RANGE, GROWTH = 512, 8

#: Every byte that is no ASCII digit or letter and below 0x80 separates terms; A-Z are lower-cased.
TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b).isalnum() and b < 0x80 else b if b >= 0x80 else 32 for b in range(256))

_LISTS = ["last", "ends", "sky_ends", "sky_tf", "sky_n"]


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits each, low ones first, and how many bytes each takes."""
    values = values.astype(np.int64)
    size = np.ones(len(values), np.int64)
    for k in range(1, 9):
        size += values >= 1 << 7 * k
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        on = size > k
        out[at[on] + k] = (values[on] >> 7 * k & 127) | np.where(size[on] > k + 1, 128, 0)
    return out, size


def unpacked(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate(([0], ends[:-1] + 1))
    shift = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * shift, starts)


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a posting adds to a score, before its term's weight."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Shard:
    """Documents and terms of one shard while it is gathered."""

    def __init__(self):
        self.vocabulary: defaultdict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.ids: list = []
        self.words: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, text: bytes) -> None:
        words = terms_of(text)
        if words:
            self.ids.append(doc_id)
            self.words.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words)))
            self.size += len(words)

    def rows(self, shard: int, id_type: pa.DataType, schema: pa.Schema, block: int) -> pa.RecordBatch:
        """A row per term, and one without a term for the documents: their ids and lengths."""
        n = len(self.ids)
        order = sorted(range(n), key=lambda i: (self.ids[i] is None, self.ids[i]))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        length = np.array([len(w) for w in self.words], np.int64)
        keys = np.concatenate(self.words).astype(np.int64) * n + np.repeat(place, length)
        self.words = []
        keys.sort()
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        tf = np.diff(np.append(first, len(keys)))
        term, doc = np.divmod(keys[first], n)
        length = length[order]
        begins = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
        df = np.diff(np.append(begins, len(term)))
        at = np.arange(len(term)) - np.repeat(begins, df)
        opens = np.flatnonzero(at % block == 0)  # first postings of blocks
        closes = np.append(opens[1:], len(term)) - 1
        delta = np.diff(doc, prepend=0)
        delta[begins] = doc[begins] + 1
        data, size = packed(np.stack([delta, tf], axis=1).ravel())
        reach = np.cumsum(size)[1::2]  # bytes up to and with each posting
        blocks = -(-df // block)
        by_term = np.concatenate(([0], np.cumsum(blocks)))
        start = np.concatenate(([0], reach[closes]))[by_term[:-1]]
        ends = reach[closes] - np.repeat(start, blocks)
        # The skyline of each block: by falling frequency, postings shorter than all before.
        number = np.repeat(np.arange(len(opens)), closes - opens + 1)
        n_of = length[doc]
        sky = np.lexsort((n_of, -tf, number))
        low = n_of[sky] - number[sky] * (int(length.max()) + 1)
        best = np.concatenate(([True], low[1:] < np.minimum.accumulate(low)[:-1]))
        sky = sky[best]
        per_block = np.bincount(number[sky], minlength=len(opens))
        sky_start = np.concatenate(([0], np.cumsum(per_block)))[by_term]
        sky_ends = np.cumsum(per_block) - np.repeat(sky_start[:-1], blocks)

        def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
            offsets = pa.py_buffer((bounds * 4).astype(np.int32))
            return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(values.astype("<i4"))])

        def with_docs(column: pa.Array, value: bytes | None = None) -> pa.Array:
            return pa.concat_arrays([column, pa.array([value], column.type)])

        names = list(self.vocabulary)
        columns = {
            "shard": pa.array(np.full(len(names) + 1, shard, np.int64)),
            "term": pa.array([*names, None], pa.binary()),
            "df": pa.array(np.append(df, n), pa.int64()),
            "words": pa.array([*[None] * len(names), int(length.sum())], pa.int64()),
            "last": with_docs(lists(doc[closes], by_term), length.astype("<i4").tobytes()),
            "ends": with_docs(lists(ends, by_term)),
            "sky_ends": with_docs(lists(sky_ends, by_term)),
            "sky_tf": with_docs(lists(tf[sky], sky_start)),
            "sky_n": with_docs(lists(n_of[sky], sky_start)),
            "postings": with_docs(
                pa.Array.from_buffers(
                    pa.binary(), len(names),
                    [None, pa.py_buffer(np.append(start, len(data)).astype(np.int32)), pa.py_buffer(data)],
                )
            ),
            "ids": pa.array([*[None] * len(names), [self.ids[i] for i in order]], pa.list_(id_type)),
        }
        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)


def build_index(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shard_words: int = SHARD_WORDS, block: int = BLOCK_POSTINGS
) -> DataFrame:
    """The index of every document: a row per shard and term, and one per shard for its documents (null term).

    A shard has ``shard_words`` words, or is one document of more. Documents without a term are in no shard.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_column].dataType
    fields = [T.StructField("shard", T.LongType()), T.StructField("term", T.BinaryType())]
    fields += [T.StructField(name, T.LongType()) for name in ("df", "words")]
    fields += [T.StructField(name, T.BinaryType()) for name in [*_LISTS, "postings"]]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(id_type))])
    arrow_id = to_arrow_type(id_type)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields[:-1]] + [("ids", pa.list_(arrow_id))])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        shard = _Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                shard.add(doc_id, text)
                if shard.size >= shard_words:
                    yield shard.rows(number, arrow_id, arrow, block)
                    shard, number = _Shard(), number + 1
        if shard.ids:
            yield shard.rows(number, arrow_id, arrow, block)

    read = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    return staged(read.mapInArrow(shards, schema), "search-index")


class PostingList:
    """One term in one shard: block maxima at hand, postings decompressed on demand."""

    def __init__(self, row: dict, w: int, m_of):
        self.w = w
        self.last = np.frombuffer(row["last"], "<i4").astype(np.int64)
        self.ends = np.frombuffer(row["ends"], "<i4")
        self.data = np.frombuffer(row["postings"], np.uint8)
        tf, n = (np.frombuffer(row[c], "<i4").astype(np.int64) for c in ("sky_tf", "sky_n"))
        ends = np.frombuffer(row["sky_ends"], "<i4")
        self.most = w * np.maximum.reduceat(part(tf, m_of(n)), np.concatenate(([0], ends[:-1])))
        self.bound = int(self.most.max())
        self.read = 0

    def postings(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and frequencies of the blocks from ``a`` up to ``b``."""
        self.read += b - a
        values = unpacked(self.data[self.ends[a - 1] if a else 0 : self.ends[b - 1]])
        return (self.last[a - 1] if a else -1) + np.cumsum(values[::2]), values[1::2]


def search_shard(lists: list[PostingList], m: np.ndarray, top: list, k: int, name_of) -> list:
    """``top`` (``k`` tuples at most: negative score, null mark, id) with the documents of a shard that belong there."""
    lists = sorted(lists, key=lambda x: x.bound)
    bounds = np.cumsum([x.bound for x in lists])
    low, size = 0, FIRST_RANGE
    while low < len(m):
        high = min(len(m), low + size)
        least = max(1, -top[-1][0]) if len(top) == k else 1
        if bounds[-1] < least:
            break
        first = int(np.searchsorted(bounds, least))  # lists before it are not essential
        score = np.zeros(high - low, np.int64)
        for x in lists[first:]:
            a, b = np.searchsorted(x.last, low), np.searchsorted(x.last, high - 1)
            if a < len(x.last):
                doc, tf = x.postings(a, min(b + 1, len(x.last)))
                on = (doc >= low) & (doc < high)
                doc, tf = doc[on], tf[on]
                score[doc - low] += x.w * part(tf, m[doc])
        found = np.flatnonzero(score) + low
        score = score[found - low]
        # What each other list can add: the maximum of the block a candidate would stand in.
        rest, held = lists[:first][::-1], []
        reach = score.copy()
        for x in rest:
            block = np.searchsorted(x.last, found)
            adds = np.append(x.most, 0)[block]
            held.append((block, adds))
            reach += adds
        on = reach >= least
        for i, x in enumerate(rest):
            found, score, reach = found[on], score[on], reach[on]
            held = [(block[on], adds[on]) for block, adds in held]
            block, adds = held[i]
            gain = np.zeros(len(found), np.int64)
            wanted = np.unique(block[block < len(x.last)])
            if len(wanted):
                breaks = np.flatnonzero(np.diff(wanted) > 1)
                for a, b in zip(wanted[np.append(0, breaks + 1)], wanted[np.append(breaks, len(wanted) - 1)], strict=True):
                    doc, tf = x.postings(a, b + 1)
                    near = np.searchsorted(doc, found)
                    hit = np.flatnonzero((near < len(doc)) & (doc[np.minimum(near, len(doc) - 1)] == found))
                    gain[hit] = x.w * part(tf[near[hit]], m[found[hit]])
            score = score + gain
            reach = reach - adds + gain
            on = reach >= least
        found, score = found[on], score[on]
        if len(found):
            best = np.lexsort((found, -score))[:k]
            top = sorted(top + [(-int(score[i]), *name_of(found[i])) for i in best])[:k]
        low, size = high, size * GROWTH
    return top


def search(
    index: DataFrame, items: DataFrame, k: int = TOP, item_column: str = "item_id", text_column: str = "text", block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item.

    Rows of ``items`` with one id are one item, null ids too, and its terms count once each; an item without a term or
    without a document that holds one has no rows. Equal scores are ordered by id, a null id last; rows of one id are
    documents of their own. Empty tables give an empty result.
    """
    spark = items.sparkSession
    small_batches(spark)
    kinds = {"item_id": items.schema[item_column].dataType, "doc_id": index.schema["ids"].dataType.elementType}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(dict.fromkeys(terms_of(t))) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            at = pa.array([i for i, x in enumerate(found) for _ in x], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array([t for x in found for t in x], pa.binary())], names=["item_id", "term"]
            )

    schema = T.StructType([T.StructField("item_id", kinds["item_id"]), T.StructField("term", T.BinaryType())])
    read = items.select(F.col(item_column).alias("item_id"), text_of(text_column).alias("text"))
    asked = staged(read.mapInArrow(cut, schema).distinct(), "search-terms")
    whole = index.where("term IS NULL").agg(F.sum("df"), F.sum("words"), F.count("*")).first()
    n_docs, n_words, n_shards = (x or 0 for x in whole)
    blocks = -(-asked.count() // block_terms)
    asked = asked.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))))
    out_schema = T.StructType(
        [T.StructField("item_id", kinds["item_id"]), T.StructField("doc_id", kinds["doc_id"]), T.StructField("score", T.LongType())]
    )
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_shards // SHARDS_PER_TASK))
    heaps = [
        _search_block(index, asked.where(F.col("_block") == i).drop("_block"), n_docs, n_words, k, out_schema, tasks)
        for i in range(blocks if n_docs else 0)
    ]
    found = reduce(DataFrame.unionByName, heaps) if heaps else spark.createDataFrame([], out_schema)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_block(index: DataFrame, asked: DataFrame, n_docs: int, n_words: int, k: int, schema: T.StructType, tasks: int) -> DataFrame:
    """The heap of each task for each item of one block; the block's terms, whose number is bounded, are broadcast."""
    vocabulary = F.broadcast(asked.select("term").distinct())
    listed = index.join(vocabulary, "term", "left_semi")
    frequency = {bytes(r["term"]): r["df"] for r in listed.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    terms: dict = {}
    for row in asked.collect():
        terms.setdefault(row["item_id"], []).append(bytes(row["term"]))
    weights = {t: w for t, df in frequency.items() if (w := weight(n_docs, df)) > 0}
    shared = asked.sparkSession.sparkContext.broadcast((terms, weights))
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def m_of(n: np.ndarray) -> np.ndarray:
        return 50 + 50 * n * n_docs // n_words

    def heaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights = shared.value
        tops: dict = {item: [] for item in terms}

        def finish(rows: list[dict]) -> None:
            docs = next(r for r in rows if r["term"] is None)
            ids = docs["ids"]
            m = m_of(np.frombuffer(docs["last"], "<i4").astype(np.int64))
            lists = {r["term"]: PostingList(r, weights[r["term"]], m_of) for r in rows if r["term"] in weights}
            for item, words in terms.items():
                own = [lists[t] for t in words if t in lists]
                if own:
                    tops[item] = search_shard(own, m, tops[item], k, lambda i: (ids[i] is None, ids[i]))

        open_, shard = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard and open_:
                    finish(open_)
                    open_ = []
                shard = row["shard"]
                open_.append(row)
        if open_:
            finish(open_)
        found = [(item, x[2], -x[0]) for item, top in tops.items() for x in top]
        columns = zip(*found, strict=True) if found else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    sent = listed.unionByName(index.where("term IS NULL")).select(*index.columns)
    return sent.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(heaps, schema)
