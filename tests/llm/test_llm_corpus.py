"""The manifest, the search and the substring deduplication against plain Python."""

from __future__ import annotations

import hashlib
import math
import os
import random
import re
import subprocess
import sys
import time
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from toitscope.llm import merkle, search, substring_dedup

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, digest string, steps string, first string"


def frame(spark, rows, schema=SCHEMA, parts=3):
    width = len(schema.split(", "))
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema).repartition(parts)


def same(got, want):
    return sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


# --- manifest -----------------------------------------------------------------------------------


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    def part(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            level = levels[-1]
            levels.append([sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            a = i // 3 * 3
            out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 3])))
            i //= 3
        return out

    sources = {}
    for doc_id, source, lang, n_chars, text in rows:
        cut = text
        if text is not None and zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 2 == 0:
            cut = text.replace("\n", "")
        leaf, altered = (sha("".join(map(part, (doc_id, source, lang, n_chars, t)))) for t in (text, cut))
        sources.setdefault(source, []).append(((doc_id is not None, doc_id or 0), leaf, altered, doc_id))
    trees = []
    for source in sorted(sources, key=lambda s: (s is not None, (s or "").encode())):
        leaves = sorted(sources[source], key=lambda x: x[:2])
        trees.append((leaves, tree([x[1] for x in leaves])))
    top = tree([levels[-1][0] for _, levels in trees])
    out = []
    for k, (leaves, levels) in enumerate(trees):
        for i, (_, leaf, altered, doc_id) in enumerate(leaves):
            steps = path(levels, i) + path(top, k)
            node = altered
            for left, right in steps:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in steps))
            out.append((doc_id, leaf, levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


@pytest.mark.parametrize("sources", [["a"], ["a", "b", None, "é", ""], [f"s{i}" for i in range(11)]])
def test_manifest_agrees_with_plain_python(spark, sources):
    draw = random.Random(len(sources))
    rows = [(i, draw.choice(sources), draw.choice(["fr", None]), i % 7 or None, draw.choice(["x\ny", "é\n", "", None, "plain"])) for i in range(120)]
    rows += [(None, sources[0], None, None, None), (None, None, None, None, "n\n"), (5, sources[0], None, 1, "again"), rows[3], rows[3]]
    assert same(merkle.verified(frame(spark, rows)).collect(), plain_manifest(rows))


@pytest.mark.parametrize("n", [1, 3, 4, 28])
def test_manifest_of_few_rows(spark, n):
    rows = [(i, "s", "en", 1, f"t{i}\n") for i in range(n)]
    assert same(merkle.verified(frame(spark, rows)).collect(), plain_manifest(rows))


def test_manifest_of_nothing(spark):
    empty = frame(spark, [(1, "s", "en", 1, "t")]).where("false")
    assert merkle.verified(empty).collect() == []


def test_a_longer_text_is_told_apart_from_a_moved_boundary(spark):
    rows = [(1, "s", "ab", 1, "c"), (2, "s", "a", 1, "bc"), (3, "s", None, 1, "-"), (4, "s", "-", 1, None)]
    found = [r["leaf"] for r in merkle.manifest(frame(spark, rows)).collect()]
    assert len(set(found)) == 4


# --- search -------------------------------------------------------------------------------------


def plain_search(docs, items, k):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    read = [(i, pattern.findall((t or "").translate(lower))) for i, t in docs]
    read = [(i, terms) for i, terms in read if terms]
    n_docs, n_words = len(read), sum(len(terms) for _, terms in read)
    df = {}
    for _, terms in read:
        for term in set(terms):
            df[term] = df.get(term, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(pattern.findall((text or "").translate(lower)))
    out = []
    for item, terms in asked.items():
        found = []
        for doc_id, words in read:
            m = 50 + 50 * len(words) * n_docs // n_words
            score = 0
            for term in terms & set(words):
                tf = words.count(term)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1))) * (1000000000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found)[:k], 1)]
    return out


def corpus(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "été", "A-b", "x_y", "日本", "Z9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(draw.choices(words, weights, k=draw.choice([1, 5, 40])))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " ,.- "), (3, docs[3][1]), (None, docs[4][1]), (n + 3, "w1 " * 3000)]
    items = [(i, " ".join(draw.choices(words, k=draw.choice([1, 3, 12])))) for i in range(25)]
    return docs, items + [(1, "w59 Été"), (None, "w3 w7"), (77, None), (78, "nowhere"), (79, "?")]


@pytest.mark.parametrize(("k", "shard_words", "block"), [(5, 300, 4), (50, 4_000_000, 128), (3, 2_000, 16)])
def test_search_agrees_with_plain_python(spark, k, shard_words, block):
    docs, items = corpus(k, 900)
    table = frame(spark, docs, "doc_id bigint, text string, term string, shard bigint")
    index = search.build_index(table, shard_words=shard_words, block=block)
    got = search.search(index, frame(spark, items, "item_id bigint, text string, rank string"), k=k, block_terms=40).collect()
    assert same(got, plain_search(docs, items, k))


def test_search_with_text_ids_and_nothing_to_find(spark):
    docs = frame(spark, [("b", "one two"), ("a", "one two"), (None, "one")], "doc_id string, text string")
    index = search.build_index(docs)
    items = frame(spark, [("q", "one TWO")], "item_id string, text string")
    assert [(r["rank"], r["doc_id"]) for r in search.search(index, items).orderBy("rank").collect()] == [(1, "a"), (2, "b"), (3, None)]
    assert search.search(search.build_index(docs.where("false")), items).collect() == []
    assert search.search(index, items.where("false")).collect() == []


def test_blocks_are_rejected_before_they_are_read():
    draw = np.random.default_rng(1)
    n = 20_000
    length = draw.integers(5, 400, n)
    shard = search._Shard()
    for i in range(n):
        shard.add(i, b"common " * int(draw.integers(1, 4)) + (b"rare " if i % (97 if i < 5000 else 997) == 0 else b"") + b"pad " * int(length[i]))
    names = ["shard", "term", "df", "words", *search._LISTS, "postings", "ids"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), *[pa.binary()] * 6, pa.list_(pa.int64())]
    rows = {r["term"]: r for r in shard.rows(0, pa.int64(), pa.schema(list(zip(names, kinds, strict=True))), 128).to_pylist()}
    m = 50 + np.frombuffer(rows[None]["last"], "<i4").astype(np.int64)
    common, rare = (search.PostingList(rows[t], w, lambda x: 50 + x) for t, w in ((b"common", 5), (b"rare", 9000)))
    top = search.search_shard([common, rare], m, [], 10, lambda i: (False, i))
    assert common.read < len(common.last) / 2
    plain = np.zeros(n, np.int64)
    for x in (common, rare):
        doc, tf = x.postings(0, len(x.last))
        plain[doc] += x.w * search.part(tf, m[doc])
    best = np.lexsort((np.arange(n), -plain))[:10]
    assert [(-t[0], t[2]) for t in top] == [(plain[i], i) for i in best]


def test_numbers_survive_packing():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**31 - 1])
    data, _ = search.packed(values)
    assert search.unpacked(data).tolist() == values.tolist()


# --- substring dedup ----------------------------------------------------------------------------


def plain_repeats(docs, least):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    order = lambda i: (i is None, i or 0)
    lowest = {}
    for i, words in split:
        for p in range(len(words) - least + 1):
            gram = tuple(words[p : p + least])
            lowest[gram] = min(lowest.get(gram, order(i)), order(i))
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for p in range(len(words) - least + 1):
            if lowest[tuple(words[p : p + least])] < order(i):
                gone[p : p + least] = [True] * least
        out.append((i, len(words), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def passages(seed, n):
    draw = random.Random(seed)
    words = [f"m{i}" for i in range(30)] + ["é", " ", " x", "日本語"]
    shared = [" ".join(draw.choices(words, k=draw.choice([5, 12, 13, 14, 40]))) for _ in range(8)]
    docs = []
    for i in range(n):
        parts = [draw.choice([" ", "\n", "\t \x0b"]).join(draw.choices(words, k=draw.randrange(20))) for _ in range(3)]
        docs.append((draw.randrange(n), draw.choice(["\n", "  "]).join([parts[0], draw.choice(shared), parts[1], draw.choice(shared), parts[2]])))
    same_words = "la " * 30
    return docs + [(1, None), (2, ""), (3, " \n"), (4, same_words), (5, same_words), (5, same_words), (None, docs[0][1]), (None, docs[0][1]), docs[7], (n, docs[7][1] * 60)]


@pytest.mark.parametrize(
    ("least", "prefix_words", "lot", "tree"), [(13, 3, 400_000, 300_000), (13, 3, 50, 40), (13, 1, 200, 100), (3, 2, 100, 64), (2, 2, 30, 64), (1, 1, 30, 64)]
)
def test_repeats_agree_with_plain_python(spark, least, prefix_words, lot, tree):
    docs = passages(least, 150)
    table = frame(spark, docs, "doc_id bigint, text string, spans string, lot string")
    found = substring_dedup.without_repeats(table, least=least, prefix_words=prefix_words, lot_suffixes=lot, tree_suffixes=tree)
    got = [(r["doc_id"], r["n_words"], r["kept"]) for r in found.collect()]
    assert same(got, plain_repeats(docs, least))


def test_repeats_of_text_ids_and_of_nothing(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = frame(spark, [("b", passage), ("a", f"x {passage} y"), (None, passage)], "doc_id string, text string")
    found = {r["doc_id"]: (r["spans"], r["kept"]) for r in substring_dedup.without_repeats(docs).collect()}
    assert found == {"a": (None, f"x {passage} y"), "b": ([0, 20], ""), None: ([0, 20], "")}
    assert substring_dedup.without_repeats(docs.where("false")).collect() == []


def test_a_long_text_is_hashed_in_pieces():
    words = [b"w%d" % (i % 5000) for i in range(400_000)]
    starts, ends, h = substring_dedup.Hasher().words(b" ".join(words))
    assert len(h) == len(words)
    assert len(np.unique(h)) == 5000
    assert (h[:5000] == h[395_000:]).all()
    assert (ends - starts).tolist()[:3] == [2, 2, 2]


def test_one_passage_in_a_third_of_all_texts_is_sent_once_a_lot(spark):
    passage = " ".join(f"hot{i}" for i in range(30))
    docs = [(i, f"d{i} " + passage if i % 3 == 0 else " ".join(f"u{i}x{j}" for j in range(40))) for i in range(600)]
    found = substring_dedup.without_repeats(frame(spark, docs, "doc_id bigint, text string"))
    assert found.where(F.col("spans").isNotNull()).count() == 199


@pytest.mark.parametrize("texts", [[], [""], ["", " \n", "a"], ["a b", "", "c\t\x0bd ", " e", "f\x1cg\xa0h"], ["x  ", "  ", "  y"], ["é 日本語", "é"]])
@pytest.mark.parametrize("kind", [pa.string(), pa.binary(), pa.large_binary()])
def test_words_of_many_texts_are_found_at_once(texts, kind):
    for skipped in range(len(texts) + 1):
        data, edges, doc = substring_dedup.words_of(pa.array([t.encode() for t in texts], pa.binary()).cast(kind).slice(skipped))
        expected = [(i, w) for i, t in enumerate(texts[skipped:]) for w in t.encode().split()]
        assert list(zip(doc.tolist(), data.split(b" ")[:-1], strict=True)) == expected
        assert [data[a:b] for a, b in zip(edges.tolist(), edges.tolist()[1:], strict=False)] == [w + b" " for _, w in expected]


def test_anchors_are_the_first_of_the_least_in_each_window():
    draw = np.random.default_rng(3)
    h = draw.integers(0, 6, 400).astype(np.uint64)
    doc = np.sort(draw.integers(0, 9, 400))
    for least, k in [(13, 3), (13, 1), (5, 5), (4, 2), (1, 1)]:
        g = substring_dedup.grams(h, k) >> np.uint64(32)
        expected = {w: w + int(np.argmin(g[w : w + least - k + 1])) for w in range(400 - least + 1) if doc[w] == doc[w + least - 1]}
        got = {w: a for first, a, last in zip(*substring_dedup.anchors(h, doc, least, k), strict=True) for w in range(first, last + 1)}
        assert got == expected


def test_a_sample_holds_the_same_words_always_or_never():
    texts = pa.array([" ".join(random.Random(i % 40).choices([f"s{j}" for j in range(500)], k=300)) for i in range(80)])
    whole, part = (substring_dedup._Lot(13, 3, pa.int64(), every) for every in (1, 8))
    for lot in (whole, part):
        lot.add(list(range(80)), [0] * 80, texts, substring_dedup.Hasher())
    assert part.size == whole.size
    assert set(part.seen) < set(whole.seen)
    assert len(whole.seen) / 12 < len(part.seen) < len(whole.seen) / 5
    assert part.leaves[0].shape[1] == 2 * len(part.seen)


def test_a_tree_takes_less_time_than_numbering_its_words_one_by_one():
    draw = random.Random(5)
    words = [b"w%d " % i for i in range(50_000)]
    lot = [[draw.choice(words) for _ in range(19)] for _ in range(60_000)]
    suffixes = pa.array([b"".join(x) for x in lot] + [b"".join(x) for x in lot[:600]], pa.large_binary())
    least_id = np.arange(len(suffixes))

    def plain():
        number = {}
        for text in suffixes.to_pylist():
            for word in text.split(b" ")[:-1]:
                number.setdefault(word, len(number))

    def taken(work):
        start = time.process_time()
        work()
        return time.process_time() - start

    def tree():
        return substring_dedup.repeated_in_tree(suffixes, np.full(len(suffixes), 3), least_id, 13, 3)

    found = tree()
    assert sorted(zip(*(x.tolist() for x in found), strict=True)) == [(60_000 + i, o, i) for i in range(600) for o in range(4)]
    assert min(taken(tree) for _ in range(3)) < 0.7 * min(taken(plain) for _ in range(3))


def test_many_small_bundles_cost_little_more_than_a_large_one():
    draw = random.Random(6)
    words = [f"w{i}" for i in range(50_000)]
    texts = pa.array([" ".join(draw.choices(words, k=500)) for _ in range(200)])
    lot = substring_dedup._Lot(13, 3, pa.int64())
    lot.add(list(range(200)), [0] * 200, texts, substring_dedup.Hasher())

    def size(trees):
        bundles = [r[3] for r in lot.rows(0, [np.zeros(0, np.uint64)] * 3, trees) if r[0] == substring_dedup._SUFFIX]
        return len(bundles), sum(map(len, bundles))

    # Most of 2,000 trees get 8 suffixes or so.
    few, one = size(1)
    many, small = size(2000)
    assert few == 1 and many > 1800
    assert small - one < 600 * many


def test_a_tree_needs_little_more_than_its_words():
    """Measured in a process of its own: the peak of a tree over its words, less than 20 bytes for each."""
    code = """
import numpy as np, pyarrow as pa
from toitscope.llm import substring_dedup
draw = np.random.default_rng(1)
vocabulary = [b"word%d " % i for i in range(5000)]
words = pa.array([b"".join([vocabulary[j] for j in row]) for row in draw.integers(0, 5000, (200_000, 19)).tolist()], pa.large_binary())
peak = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("VmHWM")).split()[1]) / 1024
open("/proc/self/clear_refs", "w").write("5")
before = peak()
substring_dedup.repeated_in_tree(words, np.full(200_000, 3), np.arange(200_000), 13, 3)
print(peak() - before)
"""
    here = Path(__file__).parents[2]
    out = subprocess.run([sys.executable, "-c", code], cwd=here, env={**os.environ, "PYTHONPATH": str(here)}, capture_output=True, text=True, check=True)
    assert float(out.stdout) < 20 * 3.8


def test_bundles_keep_numbers_ids_and_words():
    packer = zstandard.ZstdCompressor()
    for ids in (np.array([5, -1, 1 << 62]), np.array(["b", "", "é\U0010ffff"], object)):
        parts = [(np.array([9, 2, 700_000]), np.array([0, 10, 3]), ids, [b"a ", b"b c ", b"d "]), (np.array([1]), np.array([1]), ids[1:2], [b"e "])]
        size, content, place, least, words = substring_dedup._unpacked([substring_dedup._packed(packer, *x) for x in parts], ids.dtype == object)
        assert size.tolist() == [3, 1]
        assert content.tolist() == [9, 2, 700_000, 1]
        assert place.tolist() == [0, 10, 3, 1]
        assert least.tolist() == [*ids, ids[1]]
        assert words.to_pylist() == [b"a ", b"b c ", b"d ", b"e "]


def test_a_step_leaves_only_what_it_keeps(spark):
    from toitscope.llm.shared import staged, step_of

    with step_of(spark) as kept:
        early = staged(spark.range(3), "early")
        kept.append(staged(early.where("id > 0"), "late"))
    assert kept[0].count() == 2
    with pytest.raises(Exception, match="(?i)not.exist|not.found"):
        spark.read.parquet(early.staged_at).count()
