"""Best-fit packing of tokenised documents into sequences of fixed length, improved by local search.

Documents longer than a sequence are cut into full pieces and one shorter first piece; full pieces are sequences by
themselves. The rest is dealt at random into buckets of bounded size, as many as the corpus needs, and each bucket is
packed by one task: best fit of the longest first, then a search that takes the emptiest sequence and, of all fuller
ones that have room, finds the one with which moving a document or exchanging one for one, two for one or one for two
takes most tokens out of it. Partners are looked up by what they hold and the room they have, so a step costs the same
however many sequences are open. Every step raises the sum of squared fills, so the search ends by itself, when a pass
over all sequences moves nothing; a sequence that comes out empty is saved. A bucket cannot do better than one
sequence more than its tokens need, so bucketing costs at most a fraction of a sequence per bucket.
"""

from __future__ import annotations

import zlib
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toitscope.llm import bpe
from toitscope.llm.shared import small_batches, staged, text_of

CAPACITY = 2048
BUCKET_PIECES = 20_000
END_OF_TEXT = 0


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    capacity: int = CAPACITY,
    end_id: int = END_OF_TEXT,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    find_added: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: ``doc_id, piece, start, length, ids_crc32`` and, if wanted, ``ids``.

    A document is its tokens and ``end_id``, so a null or empty text is one token. Only longer ones are cut: the
    first piece takes what is left over, all others are full. With ``find_added`` the added tokens of the tokenizer's
    JSON file, such as ``<|endoftext|>``, have their own ids where they stand in a text; otherwise they are plain text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    merges = bpe.shared_merges(spark, tokenizer_path)
    added = bpe.read_added(tokenizer_path) if find_added else {}
    end = np.array([end_id], "<u4").tobytes()
    fields = [
        T.StructField("doc_id", docs.schema[id_column].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ] + [T.StructField("ids", T.BinaryType())] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = merges.value.encoder(pattern)
        for batch in batches:
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, ids in enumerate(encoder.encode_around(batch.column(1).to_pylist(), added)):
                ids += end
                n = len(ids) // 4
                first = n % capacity or capacity
                for k, a in enumerate([0, *range(first, n, capacity)]):
                    size = capacity if k else first
                    part = ids[4 * a : 4 * (a + size)]
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(part)
            columns = [
                batch.column(0).take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
            ]
            if with_ids:
                columns.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    read = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    return read.mapInArrow(cut, T.StructType(fields))


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest sequence that has room; positions of ``sizes`` by sequence."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set when some sequence has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            to = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, to = capacity, len(bins)
            bins.append([])
        bins[to].append(i)
        by_room[room - size].append(to)
        rooms |= 1 << (room - size)
    return bins


def pair_sums(items: list[int]) -> set[int]:
    """All sums of two of the sizes; few, as different sizes of one sequence add up to its capacity at most."""
    single = sorted(set(items))
    sums = {a + b for i, a in enumerate(single) for b in single[i + 1 :]}
    return sums | {2 * a for a in single if items.count(a) > 1}


def two_of(items: list[int], total: int) -> list[int]:
    """Two of the sorted sizes that add up to ``total``."""
    low, high = 0, len(items) - 1
    while items[low] + items[high] != total:
        if items[low] + items[high] < total:
            low += 1
        else:
            high -= 1
    return [items[low], items[high]]


class Partners:
    """Open sequences by what they can give back: nothing, one size or a sum of two, and the room they have.

    ``most[s]`` is at least the greatest room of a sequence that can give back ``s``; it is brought down when a look-up
    finds that nobody has so much any more.
    """

    def __init__(self, bins: list[list], capacity: int, in_pairs: bool):
        self.bins, self.capacity, self.in_pairs = bins, capacity, in_pairs
        self.most = np.full(capacity + 1, -1, np.int64)
        self.holders: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.back = np.arange(capacity + 1)

    def backs(self, i: int) -> set[int]:
        return pair_sums(self.bins[i][1]) if self.in_pairs else {0, *self.bins[i][1]}

    def add(self, i: int) -> None:
        room = self.capacity - self.bins[i][0]
        for s in self.backs(i):
            self.holders[s].add(i)
            if room > self.most[s]:
                self.most[s] = room

    def drop(self, i: int) -> None:
        for s in self.backs(i):
            self.holders[s].discard(i)

    def best(self, given: int, beyond: int) -> tuple[int, int, int]:
        """Gain, what comes back and from whom, if ``given`` goes: the greatest gain over ``beyond``, or 0."""
        n = min(given - beyond, self.capacity + 1)
        while n > 0:
            fits = self.most[:n] >= given - self.back[:n]
            back = int(fits.argmax())
            if not fits[back]:
                return 0, 0, -1
            gain = given - back
            rooms = [(self.capacity - self.bins[i][0], i) for i in self.holders[back]]
            fitting = [x for x in rooms if x[0] >= gain]
            if fitting:
                return gain, back, min(fitting)[1]
            self.most[back] = max(rooms)[0] if rooms else -1
        return 0, 0, -1


def improve(sizes: list[list[int]], capacity: int) -> list[list[int]]:
    """Empty sequences (lists of sizes) by exchanges while the tokens could do with fewer and something moves."""
    least = -(-sum(map(sum, sizes)) // capacity)
    bins = [[sum(b), sorted(b)] for b in sizes]
    number, moved = len(bins), True
    while moved and number > least:
        moved = False
        open_ = sorted((i for i, b in enumerate(bins) if 0 < b[0] < capacity), key=lambda i: bins[i][0])
        ones, twos = Partners(bins, capacity, False), Partners(bins, capacity, True)
        for i in open_:
            ones.add(i)
            twos.add(i)
        for i in open_:
            giver = bins[i]
            if giver[0] >= capacity:
                continue
            # From here on only fuller sequences take, so the sum of squares rises with every step.
            ones.drop(i)
            twos.drop(i)
            while giver[0]:
                gain, give, back, to, pair = 0, 0, 0, -1, False
                for given in sorted({*giver[1], *pair_sums(giver[1])}, reverse=True):
                    found = ones.best(given, gain)
                    if found[0] > gain:
                        gain, give, back, to, pair = found[0], given, found[1], found[2], False
                for given in sorted(set(giver[1]), reverse=True):
                    found = twos.best(given, gain)
                    if found[0] > gain:
                        gain, give, back, to, pair = found[0], given, found[1], found[2], True
                if not gain:
                    break
                taker = bins[to]
                ones.drop(to)
                twos.drop(to)
                out = [give] if give in giver[1] else two_of(giver[1], give)
                come = two_of(taker[1], back) if pair else [back] * (back > 0)
                for source, target, items in ((giver[1], taker[1], out), (taker[1], giver[1], come)):
                    for x in items:
                        source.remove(x)
                        insort(target, x)
                giver[0] -= gain
                taker[0] += gain
                moved = True
                if taker[0] < capacity:
                    ones.add(to)
                    twos.add(to)
            number -= not giver[0]
            if number <= least:
                break
    return [content for fill, content in bins if fill]


def pack_sizes(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each size."""
    first = best_fit(sizes, capacity)
    packed = improve([[int(sizes[i]) for i in b] for b in first], capacity)
    waiting: dict[int, list[int]] = {}
    for i, size in enumerate(sizes.tolist()):
        waiting.setdefault(size, []).append(i)
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for number, content in enumerate(packed):
        at = 0
        for size in reversed(content):
            i = waiting[size].pop()
            sequence[i], offset[i] = number, at
            at += size
    return sequence, offset


def pack(parts: DataFrame, capacity: int = CAPACITY, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``: sequences of at most ``capacity``, gapless from 0.

    ``length`` says how long a piece is and must lie between 1 and ``capacity``; other columns pass through, so ids
    may be null and rows may repeat, each with a place of its own. An empty table gives an empty one.
    """
    parts = staged(parts, "pieces")
    n = parts.where(F.col("length") < capacity).count()
    buckets = max(1, -(-n // bucket_pieces))
    numbered = parts.withColumn("_row", F.monotonically_increasing_id())
    whole = numbered.where(F.col("length") >= capacity).select(
        *parts.columns, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    short = numbered.where(F.col("length") < capacity).withColumn(
        "_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)).cast("bigint")
    )
    schema = T.StructType(
        [*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    names = parts.columns

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("_row")
        sequence, offset = pack_sizes(table.column("length").to_numpy(), capacity)
        sequence += (table.column("_bucket")[0].as_py() << 32)
        return table.select(names).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return whole.unionByName(short.groupBy("_bucket").applyInArrow(packed, schema))
