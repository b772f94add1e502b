"""Repeated passages of words, found in suffix trees that are partitioned by prefixes of variable length.

A window is ``least`` consecutive words. Suffixes are taken at anchors only: of the places in a window where
``PREFIX_WORDS`` words start, the anchor is the one whose words have the least hash, so equal windows have equal anchors
at equal places, and neighbouring windows share one. What is sent for an anchor is the words of all windows it stands
in: the suffix from the anchor on, and the words before it.

* Prefixes. A suffix belongs to the group of its first word, or of its first two or three where a shorter prefix has
  more suffixes than fit one tree. Groups are dealt to trees of bounded size.
* Trees. A tree is held as the sorted suffixes with the common prefixes of neighbours: an internal node at depth ``d``
  is a run of suffixes that agree in ``d`` words. Windows that lie ``o`` words before their anchor are the parts of the
  nodes at depth ``least - o`` that also agree in the ``o`` words before it. Deeper nodes are not split off, as they
  never change which windows repeat; overlapping windows join to the maximal repeats of a text.
* Answer. Every repeated window learns the least id it starts in, and a text's windows that start in a lesser one than
  its own are its repeats.

The same words are sent once from every few megabytes of text, whatever the number of texts that hold them; which texts
those are stays with the lot they were read in, and answers go back to the lots. So a passage that stands in a third
of all texts costs its tree one suffix for each lot. Suffixes travel compressed, one bundle for each lot and tree. Lots
and trees both grow with the corpus, so bundles grow as its square and get small: they have no schema of their own, are
sent many at a time, and a tree or lot reads all of its bundles at once.

Words are numbered by their bytes, whole batches and trees at a time; hashes only choose anchors, groups and samples.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from toitscope.llm.shared import small_batches, staged, text_of

LEAST_WORDS = 13
PREFIX_WORDS = 3
#: Suffixes of a lot, and of a tree.
LOT_SUFFIXES = 300_000
TREE_SUFFIXES = 200_000
#: One suffix in so many is looked at to learn which prefixes are frequent.
SAMPLED = 64
#: A null id comes after all others.
LAST_INTEGER, LAST_TEXT = (1 << 63) - 1, "\U0010ffff"

_PIECE = 1 << 20
_BREAK = re.compile(rb"[ \n]")
_TIMES, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LEAF, _SUFFIX = 0, 1
_PLACES = (1 << 32) - 1
_PARTS = "<6q"
#: Bytes of bundles that go to Spark in one batch.
_SENT = 4 << 20
#: Words are separated by U+0020 and U+0009 to U+000D.
_IN_WORD = np.ones(256, bool)
_IN_WORD[[32, 9, 10, 11, 12, 13]] = False


def words_of(texts: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of all texts, a space after each, with 0 and the end of each word after its space, and the text it is in."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    size = int(offsets[-1] - offsets[0])
    if not size:
        return b"", np.zeros(1, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8, size, int(offsets[0]))
    offsets = offsets - offsets[0]
    inside = _IN_WORD[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    border = offsets[:-1][offsets[:-1] < size]
    begins[border] = inside[border]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    border = offsets[1:][offsets[1:] > 0] - 1
    closes[border] = inside[border]
    starts = np.flatnonzero(begins)
    edges = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(np.flatnonzero(closes) + 2 - starts, out=edges[1:])
    del begins, closes
    out = np.full(int(edges[-1]), 32, np.uint8)
    letter = np.ones(len(out), bool)
    letter[edges[1:] - 1] = False
    out[letter] = raw[inside]
    return out.tobytes(), edges, np.searchsorted(offsets, starts, "right") - 1


def numbered(data: bytes | pa.Buffer, edges: np.ndarray) -> pa.DictionaryArray:
    """Words that follow each other as numbers, and the words that these stand for."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


class Hasher:
    """Hashes of all words of a text at once, by differences of running sums."""

    def __init__(self):
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            n = max(n, _PIECE + 1)
            back = np.uint64(pow(int(_TIMES), -1, 1 << 64))
            self.powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, _TIMES))))
            self.inverse = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, back))))

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and hash of each word; words are separated by one space or line break each."""
        parts, at = [], 0
        while at < len(data):
            end = len(data)
            if end - at > _PIECE:
                found = _BREAK.search(data, at + _PIECE)
                end = found.end() if found else end
            a = np.frombuffer(data, np.uint8, end - at, at)
            self._grow(len(a) + 1)
            gap = (a == 32) | (a == 10)
            starts = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
            ends = np.flatnonzero(~gap & np.concatenate((gap[1:], [True]))) + 1
            sums = np.concatenate(([np.uint64(0)], np.cumsum((a.astype(np.uint64) + np.uint64(1)) * self.powers[: len(a)])))
            parts.append((starts + at, ends + at, _mixed((sums[ends] - sums[starts]) * self.inverse[starts])))
            at = end
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each word on."""
    out = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        out = out * _TIMES + h[j : j + len(out)]
    return _mixed(out)


def anchors(h: np.ndarray, doc: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor: the first window it stands in, itself, and the last window (numbers of words)."""
    n = len(h) - least + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    # The upper half of the hash, then the place: of equal ones the first is the least.
    g = grams(h, k)
    low = (g & ~np.uint64(_PLACES)) | np.arange(len(g), dtype=np.uint64)
    width, done = least - k + 1, 1
    while 2 * done <= width:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    low = np.minimum(low[:n], low[width - done : width - done + n])
    window = np.flatnonzero(doc[:n] == doc[least - 1 :])
    at = (low[window] & np.uint64(_PLACES)).astype(np.int64)
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)))[: len(window)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    return (window[first], at[first], window[last]) if len(window) else (np.zeros(0, np.int64),) * 3


def _bundle(**columns) -> bytes:
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _opened(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def _ordered_ids(ids: pa.Array) -> np.ndarray:
    """Ids as numbers or texts in their order."""
    if pa.types.is_integer(ids.type):
        return ids.cast(pa.int64()).fill_null(LAST_INTEGER).to_numpy(zero_copy_only=False)
    return np.array([LAST_TEXT if x is None else str(x) for x in ids.to_pylist()], object)


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=0).astype(np.int32)


def _packed(packer: zstandard.ZstdCompressor, content: np.ndarray, place: np.ndarray, ids: np.ndarray, words: list[bytes] = ()) -> bytes:
    """A small bundle: a number, a place and an id for each suffix or window, and the words of suffixes."""
    if ids.dtype == object:
        texts = [x.encode() for x in ids]
        ids, texts = np.array([len(x) for x in texts], np.int32).tobytes(), b"".join(texts)
    else:
        ids, texts = ids.astype(np.int64).tobytes(), b""
    sizes = np.array([len(x) for x in words], np.int32).tobytes()
    parts = [_steps(content).tobytes(), place.astype(np.uint8).tobytes(), ids, texts, sizes, b"".join(words)]
    return packer.compress(struct.pack(_PARTS, *map(len, parts)) + b"".join(parts))


def _unpacked(bundles: list[bytes], textual: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Size of each bundle, and the numbers, places, ids and words of all of them."""
    unpacker = zstandard.ZstdDecompressor()
    columns = [[] for _ in range(6)]
    for bundle in bundles:
        raw = memoryview(unpacker.decompress(bundle))
        at = struct.calcsize(_PARTS)
        for column, n in zip(columns, struct.unpack_from(_PARTS, raw), strict=True):
            column.append(raw[at : at + n])
            at += n
    size = np.array([len(x) for x in columns[1]], np.int64)
    steps, place, ids, texts, sizes, data = (b"".join(x) for x in columns)
    content = np.cumsum(np.frombuffer(steps, np.int32), dtype=np.int64)
    content -= np.repeat(np.concatenate(([0], content))[np.cumsum(size) - size], size)
    if textual:
        ends = np.cumsum(np.frombuffer(ids, np.int32), dtype=np.int64).tolist()
        ids = np.array([texts[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)], object)
    else:
        ids = np.frombuffer(ids, np.int64)
    offsets = np.concatenate(([0], np.cumsum(np.frombuffer(sizes, np.int32), dtype=np.int64)))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return size, content, np.frombuffer(place, np.uint8).astype(np.int64), ids, words


class _Lot:
    """Texts that are read together, and their suffixes: the same words once. With ``every``, one suffix in so many is
    looked at, the same words always or never."""

    def __init__(self, least: int, k: int, id_type: pa.DataType, every: int = 1):
        self.least, self.k, self.id_type, self.every = least, k, id_type, every
        self.ids, self.hashes, self.seen = [], [], {}
        self.anchor, self.prefix, self.leaves = [], [], []
        self.size = 0

    def add(self, ids: list, hashes: list, texts: pa.Array, hasher: Hasher) -> None:
        base = len(self.ids)
        self.ids += ids
        self.hashes += hashes
        data, edges, doc = words_of(texts)
        if not len(doc):
            return
        words = numbered(data, edges)
        _, lengths, letters = words.dictionary.buffers()
        distinct = letters.slice(0, int(np.frombuffer(lengths, np.int64)[len(words.dictionary)])).to_pybytes()
        h = hasher.words(distinct)[2][words.indices.to_numpy()]
        first, anchor, last = anchors(h, doc, self.least, self.k)
        self.size += len(first)
        if self.every > 1:
            sums = np.concatenate(([np.uint64(0)], np.cumsum(h)))
            chosen = np.flatnonzero(_mixed(sums[last + self.least] - sums[first]) % np.uint64(self.every) == 0)
            first, anchor, last = first[chosen], anchor[chosen], last[chosen]
        if not len(first):
            return
        seen = self.seen
        known = len(seen)
        content = np.array(
            [seen.setdefault(data[a:b], len(seen)) for a, b in zip(edges[first].tolist(), edges[last + self.least].tolist(), strict=True)], np.int64
        )
        new = np.flatnonzero(np.diff(np.maximum.accumulate(np.maximum(content, known - 1)), prepend=known - 1) > 0)
        self.anchor.append((anchor - first)[new])
        self.prefix.append(np.stack([grams(h, q)[anchor[new]] for q in range(1, self.k + 1)]))
        opening = np.searchsorted(doc, doc[first])  # the text's first word
        self.leaves.append(np.stack([content, doc[first] + base, first - opening, anchor - first, last - first]))

    def rows(self, number: int, heavy: list[np.ndarray], trees: int) -> Iterator[tuple]:
        """Kind, lot, tree and bundle: the leaves, which only pass by, and the suffixes for each tree."""
        if not self.leaves:
            return
        leaves = np.concatenate(self.leaves, axis=1)
        names = ("content", "doc", "first", "anchor", "more")
        texts = _bundle(doc_id=pa.array(self.ids, self.id_type), text_hash=pa.array(self.hashes, pa.int64()))
        yield _LEAF, number, number % trees, _bundle(**{n: pa.array(_steps(x)) for n, x in zip(names, leaves, strict=True)}), texts
        prefix, anchor = np.concatenate(self.prefix, axis=1), np.concatenate(self.anchor)
        key = prefix[self.k - 1].copy()
        for q in reversed(range(self.k - 1)):
            short = ~np.isin(prefix[q], heavy[q])
            key[short] = prefix[q][short]
        tree = (_mixed(key) % np.uint64(trees)).astype(np.int64)
        # The least id that holds a content; texts come in any order.
        ids = _ordered_ids(pa.array(self.ids, self.id_type))
        _, rank = np.unique(ids, return_inverse=True)
        order = np.lexsort((rank[leaves[1]], leaves[0]))
        _, first = np.unique(leaves[0][order], return_index=True)
        least = ids[leaves[1][order[first]]]
        words, packer = list(self.seen), zstandard.ZstdCompressor(level=3)
        order = np.argsort(tree, kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(tree[order]) > 0)))
        for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
            own = order[a:b]
            yield _SUFFIX, number, int(tree[own[0]]), _packed(packer, own, anchor[own], least[own], [words[i] for i in own.tolist()]), None


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of the words of all suffixes, how many words each suffix has, and how many words are different."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    data = words.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    edges = np.zeros(len(spaces) + 1, np.int64)
    np.add(spaces, 1, out=edges[1:])
    del spaces
    number = numbered(data, edges)
    return number.indices.to_numpy(), np.diff(np.searchsorted(edges, offsets - offsets[0])), len(number.dictionary)


def _in_one(columns: np.ndarray, bound: int) -> list[np.ndarray]:
    """Columns of numbers from -1 to ``bound``, as many of them in each key as fit; keys order rows as columns do."""
    each = max(1, 62 // (bound + 2).bit_length())
    keys = []
    for j in range(0, columns.shape[1], each):
        key = np.zeros(len(columns), np.int64)
        for column in columns.T[j : j + each]:
            key = key * (bound + 2) + column + 1
        keys.append(key)
    return keys


def repeated_in_tree(words: pa.Array, anchor: np.ndarray, least_id: np.ndarray, least: int, k: int) -> tuple[np.ndarray, ...]:
    """Suffix, place before the anchor and least id of every window that also starts in a text of lesser id.

    ``words`` holds those of a suffix, a space after each."""
    codes, total, different = _codes(words)
    here, size = np.cumsum(total) - total + anchor, total - anchor
    right = np.full((len(total), least), -1, np.int32)
    for j in range(least):
        on = np.flatnonzero(size > j)
        right[on, j] = codes[here[on] + j]
    order = np.lexsort(_in_one(right, different)[::-1])
    right = right[order]
    same = right[1:] == right[:-1]
    common = np.where(same.all(axis=1), least, same.argmin(axis=1))
    del right, same
    # The longest prefix of a suffix that another one has: deeper nodes are its own.
    longest = np.zeros(len(total), np.int64)
    longest[order] = np.maximum(np.concatenate(([0], common)), np.concatenate((common, [0])))

    def nodes(depth: int) -> np.ndarray:
        node = np.empty(len(total), np.int64)
        node[order] = np.concatenate(([0], np.cumsum(common < depth)))
        return node

    value, rank = np.unique(least_id, return_inverse=True)
    # Suffixes that share a prefix and the words before it with others; no others have windows that repeat.
    on = np.flatnonzero(longest >= k)
    before = nodes(k)[on]
    out = []
    for o in range(least - k + 1):
        depth = least - o
        if o:
            reach = anchor[on] >= o
            on, before = on[reach], before[reach]
            _, before, many = np.unique(before * different + codes[here[on] - o], return_inverse=True, return_counts=True)
            shared = many[before] > 1
            on, before = on[shared], before[shared]
        if not len(on):
            break
        inside = (longest[on] >= depth) & (size[on] >= depth)
        whole = on[inside]
        if not len(whole):
            continue
        part = nodes(depth)[whole] * len(total) + before[inside]
        by = np.lexsort((rank[whole], part))
        starts = np.flatnonzero(np.concatenate(([True], np.diff(part[by]) != 0)))
        lowest = np.repeat(rank[whole][by[starts]], np.diff(np.append(starts, len(by))))
        hit = lowest < rank[whole][by]
        out.append((whole[by[hit]], np.full(int(hit.sum()), o), value[lowest[hit]]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), value[:0]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _spans(table: pa.Table, least: int, k: int) -> Iterator[tuple]:
    """Text and repeated stretches (first word, end, ...) of one lot, from its leaves and the answers of the trees."""
    rows = table.to_pylist()
    own = next(r for r in rows if r["kind"] == _LEAF)
    texts = _opened(own["texts"])
    raw, hashes = texts.column("doc_id"), texts.column("text_hash")
    ids = _ordered_ids(raw)
    content, doc, first, anchor, more = (np.cumsum(c.to_numpy().astype(np.int64)) for c in _opened(own["bundle"]).columns)
    if not len(content):
        return
    value, rank = np.unique(ids, return_inverse=True)
    textual = not pa.types.is_integer(raw.type)
    _, of, at_place, least_id, _ = _unpacked([r["bundle"] for r in rows if r["kind"] == _SUFFIX], textual)
    # The least id of each content in this lot, and of each of its windows in the corpus, as a rank among the lot's own.
    order = np.lexsort((rank[doc], content))
    _, at = np.unique(content[order], return_index=True)
    lowest = np.repeat(rank[doc[order[at]]][:, None].astype(np.float64), least - k + 1, axis=1)
    # An id that is not in this lot stands between two that are.
    above = np.searchsorted(value, least_id)
    lowest[of, at_place] = above - np.where(value[np.minimum(above, len(value) - 1)] == least_id, 0, 0.5)
    leaf = np.repeat(np.arange(len(content)), more + 1)
    step = np.arange(len(leaf)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    place = anchor[leaf] - step
    hit = rank[doc[leaf]] > lowest[content[leaf], place]
    text, start = doc[leaf][hit], first[leaf][hit] + step[hit]
    if not len(text):
        return
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (start[1:] > start[:-1] + least)))
    begins = np.flatnonzero(new)
    closes = np.append(begins[1:], len(text)) - 1
    both = np.stack([start[begins], start[closes] + least], axis=1)
    cuts = np.flatnonzero(np.concatenate(([True], np.diff(text[begins]) != 0)))
    for a, b in zip(cuts, np.append(cuts[1:], len(begins)), strict=True):
        i = int(text[begins[a]])
        yield raw[i].as_py(), hashes[i].as_py(), both[a:b].ravel().tolist()


def repeats(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    prefix_words: int = PREFIX_WORDS,
    lot_suffixes: int = LOT_SUFFIXES,
    tree_suffixes: int = TREE_SUFFIXES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Texts with repeats: ``doc_id, text_hash, spans`` (numbers of words: first and end of each stretch, one after the
    other). Stretches are made of windows of ``least`` words that also start in a text of lesser id."""
    if not 0 < prefix_words <= least:
        raise ValueError("a prefix has at least one word and at most as many as a window")
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_column].dataType
    id_type = to_arrow_type(kind)
    read = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text_of(text_column)).alias("text_hash"), text_of(text_column).alias("text"))

    def lots(batches: Iterator[pa.RecordBatch], every: int = 1) -> Iterator[_Lot]:
        hasher, lot = Hasher(), _Lot(least, prefix_words, id_type, every)
        for batch in batches:
            lot.add(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), hasher)
            if lot.size >= lot_suffixes:
                yield lot
                lot = _Lot(least, prefix_words, id_type, every)
        if lot.ids:
            yield lot

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in lots(batches, SAMPLED):
            if not lot.prefix:
                continue
            prefix = np.concatenate(lot.prefix, axis=1)
            words, counts = [], []
            for q in range(prefix_words):
                words += [np.full(prefix.shape[1], q)]
                counts += [prefix[q].view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(words)), pa.array(np.concatenate(counts))], names=["words", "prefix"])

    census = staged(read.mapInArrow(sampled, "words bigint, prefix bigint").groupBy("words", "prefix").count(), "prefixes")
    total = SAMPLED * (census.where("words = 0").agg(F.sum("count")).first()[0] or 0)
    trees = max(1, -(-total // tree_suffixes))
    # Every frequent prefix has as many suffixes as a tree, so there are no more of them than trees for each length.
    frequent = census.where((F.col("words") < prefix_words - 1) & (F.col("count") * SAMPLED > tree_suffixes)).collect()
    heavy = spark.sparkContext.broadcast(
        [np.array([r["prefix"] for r in frequent if r["words"] == q], np.int64).view(np.uint64) for q in range(prefix_words)]
    )
    fields = [("kind", T.IntegerType()), ("lot", T.LongType()), ("tree", T.LongType()), ("bundle", T.BinaryType()), ("texts", T.BinaryType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    arrow = pa.schema([("kind", pa.int32()), ("lot", pa.int64()), ("tree", pa.int64()), ("bundle", pa.binary()), ("texts", pa.binary())])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for lot in lots(batches):
            rows, size = [], 0
            for row in lot.rows(number, heavy.value, trees):
                rows.append(row)
                size += len(row[3]) + len(row[4] or b"")
                if size >= _SENT:
                    yield as_batch(rows)
                    rows, size = [], 0
            if rows:
                yield as_batch(rows)
            number += 1

    def grown(table: pa.Table) -> pa.Table:
        """The leaves as they came, and the answers for each lot with a suffix in this tree."""
        passing = table.filter(pc.equal(table.column("kind"), _LEAF))
        rows = table.filter(pc.equal(table.column("kind"), _SUFFIX))
        if not len(rows):
            return passing
        size, content, anchor, least_id, words = _unpacked(rows.column("bundle").to_pylist(), not pa.types.is_integer(id_type))
        found, place, lower = repeated_in_tree(words, anchor, least_id, least, prefix_words)
        of = np.repeat(np.arange(len(rows)), size)[found]
        order = np.lexsort((found, of))
        cuts = np.searchsorted(of[order], np.arange(len(rows) + 1))
        packer = zstandard.ZstdCompressor(level=3)
        lot, tree = rows.column("lot").to_pylist(), rows.column("tree").to_pylist()
        out = {f.name: [] for f in arrow}
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            own = order[cuts[i] : cuts[i + 1]]
            answer = _packed(packer, content[found[own]], place[own], lower[own])
            for name, value in zip(out, (_SUFFIX, lot[i], tree[i], answer, None), strict=True):
                out[name].append(value)
        return pa.concat_tables([passing.cast(arrow), pa.table(out, schema=arrow)])

    answered = staged(read.mapInArrow(sent, schema).groupBy("tree").applyInArrow(grown, schema), "suffix-trees")
    marks = T.StructType(
        [T.StructField("doc_id", kind), T.StructField("text_hash", T.LongType()), T.StructField("spans", T.ArrayType(T.IntegerType()))]
    )
    marks_arrow = pa.schema([("doc_id", id_type), ("text_hash", pa.int64()), ("spans", pa.list_(pa.int32()))])

    def marked(table: pa.Table) -> pa.Table:
        found = list(_spans(table, least, prefix_words))
        columns = zip(*found, strict=True) if found else ([], [], [])
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, marks_arrow, strict=True)], schema=marks_arrow)

    # Rows of one id and text have the same stretches, in whichever lot they were read.
    return staged(answered.groupBy("lot").applyInArrow(marked, marks), "repeats").groupBy("doc_id", "text_hash").agg(F.first("spans").alias("spans"))


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **how) -> DataFrame:
    """``doc_id, n_words, spans, kept``: every text without the words of its repeats, what stays joined by one space.

    Null ids come after all others and are one id, so texts without an id are never compared with each other; rows of
    one id are not either. Ids that are no integers are ordered as text. Null and empty texts have no words, texts of
    fewer words than a window no repeats. Other columns of ``docs`` are not read, whatever their names; an empty table
    gives an empty one.
    """
    found = repeats(docs, id_column=id_column, text_column=text_column, **how)
    kind = docs.schema[id_column].dataType
    read = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text_of(text_column)).alias("text_hash"), text_of(text_column).alias("text"))

    def shrunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data, edges, doc = words_of(batch.column(2))
            border = edges[np.searchsorted(doc, np.arange(len(batch) + 1))].tolist()
            texts = [packer.compress(data[a : max(a, b - 1)]) for a, b in zip(border, border[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=["doc_id", "text_hash", "shrunk"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            n, kept = [], []
            for data, spans in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = unpacker.decompress(data)
                n.append(text.count(b" ") + 1 if text else 0)
                if spans:
                    words = text.split(b" ")
                    edges = [0, *spans, len(words)]
                    text = b" ".join(w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b])
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), batch.column(1), pa.array(kept, pa.binary())], names=["doc_id", "n_words", "spans", "kept"]
            )

    small = T.StructType([T.StructField("doc_id", kind), T.StructField("text_hash", T.LongType()), T.StructField("shrunk", T.BinaryType())])
    marks = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    at_row = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    # Merged at every size: texts move once, compressed, and a hot row is split.
    joined = read.mapInArrow(shrunk, small).join(marks.hint("merge"), at_row, "left").select("doc_id", "spans", "shrunk")
    fields = [T.StructField("doc_id", kind), T.StructField("n_words", T.LongType())]
    fields += [T.StructField("spans", T.ArrayType(T.IntegerType())), T.StructField("kept", T.BinaryType())]
    return joined.mapInArrow(cut, T.StructType(fields)).withColumn("kept", F.col("kept").cast("string"))
