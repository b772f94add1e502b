"""Byte-level BPE: encode whole texts to token ids by ranks, and decode ids to bytes.

A text is split by the tokenizer's pattern and every match is merged on its own. A segment tree over the byte
positions of a match holds, at its root, the leftmost pair of least rank; a merge changes three leaves (the merged
pair, its left and its right neighbour), and their paths to the root are computed anew. Matches of up to 64 bytes
are merged many at a time: row ``i`` of one array is the tree of match ``i`` and each numpy step merges one pair in
every unfinished row. Longer matches have a tree of their own.

Words repeat, so a worker keeps the ids of the words it has met, up to a bound, and looks for the pattern only in new
ones. The text is first cut before each single space: a match of the pattern never reaches across such a space
unless white space follows it, and texts where it does take the pattern as a whole.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toitscope.llm.shared import small_batches, text_of

NONE = np.int32(1 << 30)
SIDE = 20
WIDEST = 64
CACHE_WORDS = 800_000
CACHE_CHARS = 256
LOCKSTEP_BYTES = 1 << 19


def byte_letters() -> dict[str, int]:
    """The printable letter that tokenizer files write for each byte, as the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ids, from a rank file (``token rank`` in base 64) or a tokenizer's JSON file."""
    with open(path, "rb") as file:
        data = file.read()
    if not path.endswith(".json"):
        ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in data.splitlines() if x)}
    else:
        tokenizer = json.loads(data)
        letters = byte_letters()
        special = {token["content"] for token in tokenizer["added_tokens"]}
        vocabulary = {t: i for t, i in tokenizer["model"]["vocab"].items() if t not in special}
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[token] for token in tokens] != list(range(len(tokens))):
        raise ValueError(f"ids in {path} have gaps")
    return tokens


def read_added(path: str) -> dict[str, int]:
    """Ids of the added tokens of a tokenizer's JSON file, which its library finds in a text before it merges."""
    with open(path, "rb") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if any(token.get(rule) for rule in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has a rule for {token['content']} that is not known here")
    return {token["content"]: token["id"] for token in added}


class Merges:
    """Pairs of tokens that merge, and the id each pair becomes (its rank), in an open-addressing hash table."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.encoders: dict[str, Encoder] = {}
        ids = {token: i for i, token in enumerate(tokens)}
        pairs = {}
        for token, i in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << SIDE | right] = i
        self.pairs = pairs
        self.of_byte = np.array([ids[bytes([b])] for b in range(256)], dtype=np.int32)
        self.bits = max(8, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        key = np.array(list(pairs), dtype=np.int64)
        rank = np.array(list(pairs.values()), dtype=np.int32)
        slot = self.slots(key)
        while key.size:
            first = np.zeros(key.size, bool)
            first[np.unique(slot, return_index=True)[1]] = True
            first &= self.keys[slot] < 0
            self.keys[slot[first]], self.ranks[slot[first]] = key[first], rank[first]
            key, rank, slot = key[~first], rank[~first], (slot[~first] + 1) & (len(self.keys) - 1)

    def encoder(self, pattern: str) -> Encoder:
        """The encoder of this process: a broadcast table stays in a worker from task to task, and so do its words."""
        if pattern not in self.encoders:
            self.encoders[pattern] = Encoder(self, pattern)
        return self.encoders[pattern]

    def slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE for pairs that do not merge and for ids below 0."""
        key = left.astype(np.int64) << SIDE | right
        slot = self.slots(key)
        met = self.keys.take(slot)
        out = self.ranks.take(slot)
        open_ = np.flatnonzero((met != key) & (met >= 0))
        out[(met != key)] = NONE
        while open_.size:
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            met = self.keys.take(slot[open_])
            same = met == key[open_]
            out[open_[same]] = self.ranks.take(slot[open_[same]])
            open_ = open_[~same & (met >= 0)]
        out[(left < 0) | (right < 0)] = NONE
        return out


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, merges: Merges, pattern: str, cache_words: int = CACHE_WORDS):
        self.merges, self.find, self.cache_words = merges, regex.compile(pattern).findall, cache_words
        self.words: dict[str, bytes] = {}  # ids of a word with one space before it
        self.bare: dict[str, bytes] = {}  # ids of other matches

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [text.split(" ") for text in texts]
        unmet = [set(words).difference(self.words) for words in split]
        fresh = set().union(*unmet)
        crossing = {w for w in fresh if not w or w[0].isspace() or len(w) > CACHE_CHARS}
        # The first word has no space before it; it and the texts with crossing matches take the pattern directly.
        whole = [bool(crossing) and not crossing.isdisjoint(words) for words in unmet]
        found = [
            self.find(text if direct else words[0]) for text, words, direct in zip(texts, split, whole, strict=True)
        ]
        fresh -= crossing
        words, bare = self.words, self.bare
        plain = {word for word in fresh if word.isalpha()}
        ended = [word for word in fresh if word[-1] in ",." and word[:-1].isalpha()]
        fresh -= plain
        fresh.difference_update(ended)
        plain.update([w for w in [word[:-1] for word in ended] if w not in words])
        some = list(plain)
        words.update(zip(some, self.merge([b" " + word.encode() for word in some]), strict=True))
        inner = [self.find(" " + word) for word in fresh]
        parts = {",", "."}.union(*found, *inner).difference(bare)
        bare.update([(part, words[part[1:]]) for part in parts if part[0] == " " and part[1:] in words])
        some = list(parts.difference(bare))
        bare.update(zip(some, self.merge([part.encode("utf-8", "surrogatepass") for part in some]), strict=True))
        ids = bare.__getitem__
        words.update([(word, words[word[:-1]] + bare[word[-1]]) for word in ended])
        words.update([(word, b"".join(map(ids, parts))) for word, parts in zip(fresh, inner, strict=True)])
        known = words.__getitem__
        out = [
            b"".join(map(ids, parts)) + (b"" if direct else b"".join(map(known, row[1:])))
            for row, parts, direct in zip(split, found, whole, strict=True)
        ]
        for part in [part for part in some if len(part) > CACHE_CHARS]:
            del bare[part]
        if len(words) > self.cache_words:
            words.clear()
        if len(bare) > self.cache_words // 4:
            bare.clear()
        return out

    def encode_around(self, texts: list[str], added: dict[str, int]) -> list[bytes]:
        """Ids of texts in which ``added`` tokens stand for themselves and the parts between them are texts of their own."""
        if not any(token in text for token in added for text in texts):
            return self.encode(texts)
        # Of tokens that begin at one place the longest is meant.
        cut = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")").split
        parts = [cut(text) for text in texts]
        between = iter(self.encode([part for some in parts for part in some[::2]]))
        ids = {token: np.array([i], "<u4").tobytes() for token, i in added.items()}
        return [b"".join(ids[part] if k % 2 else next(between) for k, part in enumerate(some)) for some in parts]

    def merge(self, data: list[bytes]) -> list[bytes]:
        """Ids of each match."""
        size = np.fromiter(map(len, data), np.int64, len(data))
        width = np.exp2(np.ceil(np.log2(np.maximum(size, 2)))).astype(np.int64)
        out = [b""] * len(data)
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w).tolist()
            step = max(1, LOCKSTEP_BYTES // w)
            for i in range(0, len(at), step):
                group = [data[k] for k in at[i : i + step]]
                merged = [self.merge_long(x) for x in group] if w > WIDEST else self.merge_many(group, w)
                for k, ids in zip(at[i : i + step], merged, strict=True):
                    out[k] = ids
        return out

    def merge_many(self, words: list[bytes], width: int) -> list[bytes]:
        """Merge words of at most ``width`` bytes, a power of two, one pair of each word a step.

        Arrays are flat: word ``i`` has its leaves at ``2 * width * i + width`` and its positions, with a last one
        that stands for the end, at ``(width + 1) * i``.
        """
        n, wide, lookup = len(words), width + 1, self.merges.lookup
        size = np.fromiter(map(len, words), np.int64, n)
        raw = np.array(words, f"S{width}").view(np.uint8).reshape(n, width)
        columns = np.arange(width, dtype=np.int32)
        ids = np.full((n, wide), -1, np.int32)
        ids[:, :width] = np.where(columns < size[:, None], self.merges.of_byte[raw], -1)
        tree = np.full((n, 2 * width), NONE, np.int32)
        rank = lookup(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width)
        tree[:, width:] = np.where(rank < NONE, rank * width + columns, NONE)
        for level in (1 << k for k in range(width.bit_length() - 2, -1, -1)):
            below = tree[:, 2 * level : 4 * level]
            tree[:, level : 2 * level] = np.minimum(below[:, ::2], below[:, 1::2])
        after = np.tile(np.arange(1, width + 2, dtype=np.int32), n)
        before = np.tile(np.arange(-1, width, dtype=np.int32), n)
        ids, tree = ids.ravel(), tree.ravel()
        row = np.arange(n)
        while True:
            least = tree.take(row * (2 * width) + 1)
            row, least = row[least < NONE], least[least < NONE]
            if not row.size:
                break
            start, top = row * wide, row * (2 * width)
            at = least % width
            here = start + at
            gone = after.take(here)
            then = np.minimum(after.take(start + gone), width)
            new = least // width
            ids[here] = new
            ids[start + gone] = -1
            after[here] = then
            before[start + then] = at
            left = before.take(here)
            linked = np.flatnonzero(left >= 0)
            some = left[linked]
            right_rank = lookup(new, ids.take(start + then))
            left_rank = lookup(ids.take(start[linked] + some), new[linked])
            tree[top + width + at] = np.where(right_rank < NONE, right_rank * width + at, NONE)
            tree[top + width + gone] = NONE
            tree[top[linked] + width + some] = np.where(left_rank < NONE, left_rank * width + some, NONE)
            node = np.concatenate([at, gone, some]) + width
            top = np.concatenate([top, top, top[linked]])
            for _ in range(width.bit_length() - 1):
                node >>= 1
                pair = top + 2 * node
                tree[top + node] = np.minimum(tree.take(pair), tree.take(pair + 1))
        kept = ids.reshape(n, wide) >= 0
        data = ids[kept.ravel()].astype("<u4").tobytes()
        ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def merge_long(self, word: bytes) -> bytes:
        """Merge one long match; a tree node holds the least rank below it and its leftmost position."""
        rank, none = self.merges.pairs.get, 1 << 62
        ids = self.merges.of_byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        width = 1 << (n - 1).bit_length()
        shift = width.bit_length()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * width)

        def leaf(i: int, j: int) -> int:
            found = rank(ids[i] << SIDE | ids[j]) if i >= 0 and j < n else None
            return none if found is None else found << shift | i

        for i in range(n - 1):
            tree[width + i] = leaf(i, i + 1)
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int, value: int) -> None:
            k = width + i
            tree[k] = value
            while k > 1:
                k >>= 1
                least = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == least:
                    return
                tree[k] = least

        while tree[1] != none:
            least = tree[1]
            at = least & ((1 << shift) - 1)
            gone = after[at]
            then = after[gone]
            ids[at], ids[gone], after[at] = least >> shift, -1, then
            put(gone, none)
            put(at, leaf(at, then))
            if then < n:
                before[then] = at
            if before[at] >= 0:
                put(before[at], leaf(before[at], at))
        return np.array([i for i in ids if i >= 0], dtype="<u4").tobytes()


def shared_merges(spark: SparkSession, ranks_path: str):
    """The merges for every task; their size is that of the vocabulary, whatever the corpus."""
    return spark.sparkContext.broadcast(Merges(read_ranks(ranks_path)))


def _ids_column(batches: Iterator[pa.RecordBatch], merges, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder = merges.value.encoder(pattern)
    for batch in batches:
        ids = encoder.encode(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Token ids of every whole text: ``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers as binary).

    A null or empty text has no ids; a null id stays null; repeated rows are encoded each; other columns of ``docs``
    are not read, whatever their names; an empty table gives none.
    """
    spark = docs.sparkSession
    small_batches(spark)
    merges = shared_merges(spark, ranks_path)
    kind = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("ids", T.BinaryType())])
    read = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    return read.mapInArrow(lambda batches: _ids_column(batches, merges, pattern), schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` and the bytes its ``ids`` stand for in ``decoded``; null ids give no bytes, an unknown id is an error."""
    spark = encoded.sparkSession
    small_batches(spark)
    tokens = spark.sparkContext.broadcast(read_ranks(ranks_path))
    at = encoded.columns.index("ids")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens.value.__getitem__
        for batch in batches:
            ids = [np.frombuffer(x or b"", "<u4").tolist() for x in batch.column(at).to_pylist()]
            texts = pa.array([b"".join(map(token, some)) for some in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(decoded, schema)
