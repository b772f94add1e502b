"""Tokens, exact copies, near copies, repeated lines and packing against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from toitscope.llm import bpe, exact_dedup, line_dedup, near_dedup, packing, queries

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, kept string, n long, size string, digest string, tree int, chunk string, row int"
WORDS = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "en", "ior", "ul")]


def prose(seed: int, n: int) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=n))


MESSY = [
    (None, "no id at all"),
    (None, None),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r"),
    (4, "Ça va? I'll  go\n\n \n日本 12½ \U0001f600 <|endoftext|>"),
    (5, "x" * 3000 + " " + "ab" * 2000),
    (6, prose(1, 30_000)),
    (7, "same text"),
    (7, "same text"),
    (8, "same  text "),
    (9, "sametext"),
    (10, "\x1c\x85\xa0​ a b"),
    (11, "one"),
    (12, "one two"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y", "z", 2, "c", 3) for row in rows], SCHEMA)


@pytest.fixture(scope="module")
def messy(spark):
    return frame(spark, MESSY).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def test_bpe_equals_tiktoken_and_round_trips(messy):
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(RANKS))}
    known = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = bpe.decode(bpe.encode(messy, RANKS, PATTERN), RANKS).collect()
    got = sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist(), bytes(r["decoded"])) for r in out)
    want = sorted((str(i), known.encode_ordinary(t or ""), (t or "").encode()) for i, t in MESSY)
    assert got == want


def test_bpe_on_random_text():
    encoder = bpe.Encoder(bpe.Merges(bpe.read_ranks(RANKS)), PATTERN, cache_words=50)
    ranks = {t: i for i, t in enumerate(encoder.merges.tokens)}
    known = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    letters = list("ab e'sst\n\t \x0b\x1c\x85\xa0é日12½.,!?-\U0001f600ſ") + ["'ll", "  ", " \n"]
    source = random.Random(3)
    texts = ["".join(source.choices(letters, k=source.randint(0, 40))) for _ in range(4000)]
    for i in range(0, len(texts), 97):
        some = texts[i : i + 97]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(some)] == known.encode_ordinary_batch(some)


def test_bpe_long_match_has_a_tree_of_its_own():
    encoder = bpe.Encoder(bpe.Merges(bpe.read_ranks(RANKS)), PATTERN)
    word = "".join(random.Random(5).choices("abcdeé", k=64)).encode()[:64]
    assert encoder.merge_long(word) == encoder.merge_many([word], 64)[0]


def test_bpe_of_no_rows(empty):
    assert bpe.decode(bpe.encode(empty, RANKS, PATTERN), RANKS).count() == 0


def test_both_files_hold_one_vocabulary():
    assert bpe.read_ranks(JSON) == bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i or 0, i))
    out = []
    for i, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[body])
        kept = best[3] == i and -best[0] == len(text or "")
        out.append((str(i), str(best[3]), len(groups[body]), kept, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_copies(messy, digest_all):
    rows = exact_dedup.copies(messy, digest_all=digest_all).collect()
    got = [(str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in rows]
    want = exact_by_hand(MESSY)
    if digest_all:
        assert sorted(got) == want
    else:
        assert sorted(r[:4] for r in got) == [r[:4] for r in want]
        assert {r[4] for r in got} - {None} <= {r[4] for r in want}
        assert all(r[4] is not None for r in got if r[2] > 1)


def test_exact_copies_with_equal_lengths_and_prefixes(spark):
    rows = [(i, "p" * 70 + letter) for i, letter in enumerate("aabbbc")] + [(9, "q" * 71)]
    got = exact_dedup.copies(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == [
        (0, 0, 2), (1, 0, 2), (2, 2, 3), (3, 2, 3), (4, 2, 3), (5, 5, 1), (9, 9, 1)
    ]


def test_exact_copies_of_no_rows(empty):
    assert exact_dedup.copies(empty).count() == 0


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_by_hand(rows, size, percent):
    sets = [shingles(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        key = find(i)
        if doc_id is not None:
            least[key] = min(doc_id, least.get(key, doc_id))
    return sorted((str(r[0]), len(sets[i]), str(least.get(find(i)))) for i, r in enumerate(rows))


def changed(text, n, seed):
    words, source = text.split(), random.Random(seed)
    for _ in range(n):
        words[source.randrange(len(words))] = source.choice(WORDS)
    return " ".join(words)


def near_rows():
    rows = list(MESSY)
    for group in range(12):
        base = prose(100 + group, 160)
        rows += [(1000 + 20 * group + k, changed(base, k % 4, 7 * group + k)) for k in range(1 + group)]
    base = prose(77, 120)
    return rows + [(5000 + k, changed(base, 2, k)) for k in range(150)] + [(6000, "ONE"), (6001, "two one"), (6002, "One\ttwo")]


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_copies_equal_brute_force(spark, size, percent):
    rows = near_rows()
    found = near_dedup.near_texts(frame(spark, rows).repartition(5), size, percent).collect()
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found)
    assert got == near_by_hand(rows, size, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_one_of_each_group_stays(spark):
    rows = near_rows() + [(5003, changed(prose(77, 120), 2, 3)), (None, prose(901, 50)), (None, prose(902, 50))]
    docs = frame(spark, rows)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    want = {r[2] for r in near_by_hand(rows, 5, 80) if r[2] != "None"}
    assert {i for i in ids if i != "None"} == want
    assert len([i for i in ids if i != "None"]) == len(want)
    # Three texts without an id differ from each other, and one row has neither text nor id.
    assert ids.count("None") == 4


def test_repeated_row_without_a_group_is_kept_once(spark):
    rows = [(1, prose(1, 40)), (1, prose(1, 40)), (1, prose(2, 40)), (2, ""), (2, "")]
    kept = sorted((r["doc_id"], r["text"]) for r in near_dedup.keep_one(frame(spark, rows)).collect())
    assert kept == sorted([(1, prose(1, 40)), (1, prose(2, 40)), (2, ""), (2, "")])


def test_near_copies_of_no_rows(empty):
    assert near_dedup.near_texts(empty).count() == 0
    assert near_dedup.keep_one(empty).count() == 0


def lines_by_hand(rows):
    seen = defaultdict(list)
    spans = defaultdict(set)
    for i, text in rows:
        data = (text or "").encode()
        for _, a, b in line_dedup.line_chunks(data, 2, 2, 2, 10):
            seen[data[a:b]].append(((i is None, i or 0), data, a, b))
    for places in seen.values():
        first = min(places, key=lambda p: (p[0], p[2]))
        for place in places:
            if (place[0], place[1], place[2]) != (first[0], first[1], first[2]):
                spans[place[0], place[1]].add((place[2], place[3]))
    out = []
    for i, text in rows:
        found = spans.get(((i is None, i or 0), (text or "").encode()))
        out.append((str(i), line_dedup.without(text or "", list(found)) if found else text))
    return sorted(out, key=str)


def passage_rows():
    passage = "\n".join(prose(500 + k, 14) for k in range(12))
    rows = [(i, t) for i, t in MESSY if i not in (7,)]
    for k in range(30):
        rows.append((200 + k, f"{prose(k, 9)}\n{prose(k + 50, 11)}\n{passage}\n{prose(k + 90, 8)}"))
    rows.append((300, "\n".join(prose(700 + k, 10) for k in range(20))))
    rows += [(400, passage + "\n" + passage), (None, passage)]
    return rows, passage


def test_repeated_passages_go_and_the_rest_stays(spark):
    rows, passage = passage_rows()
    docs = frame(spark, rows).repartition(4)
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    got = sorted(((str(r["doc_id"]), r["text"]) for r in out.collect()), key=str)
    assert got == lines_by_hand(rows)
    texts = dict(got)
    assert texts["200"] == dict((str(i), t) for i, t in rows)["200"]
    assert texts["300"] == dict((str(i), t) for i, t in rows)["300"]
    kept = sum(line in (texts[str(k)] or "") for k in range(201, 230) for line in passage.split("\n"))
    assert kept < 0.4 * 29 * 12


@pytest.mark.parametrize("n", range(1, 13))
def test_all_of_a_repeated_passage_goes(spark, n):
    passage = "\n".join(prose(800 + 20 * n + k, 60 if n == 1 else 6) for k in range(n))
    text = lambda k: f"{prose(k, 9)}\n{prose(k + 50, 11)}\n{passage}\n{prose(k + 90, 8)}"
    rest = lambda k: f"{prose(k, 9)}\n{prose(k + 50, 11)}\n{prose(k + 90, 8)}"
    out = line_dedup.drop_repeated_lines(frame(spark, [(k, text(k)) for k in range(5)]), whole=True)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {0: text(0)} | {k: rest(k) for k in range(1, 5)}


def whole_passages_by_hand(rows):
    """Every span of lines against every other one."""
    seen, gone = defaultdict(list), defaultdict(set)
    for i, text in rows:
        lines = text.split("\n")
        words = [len(x.split()) for x in lines]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                n, full = sum(words[a : b + 1]), sum(map(bool, words[a : b + 1]))
                ended = words[a] and words[b] and full > 1 and n > 9
                if ended or (a == b and n > 50) or (b == a + 1 and full == 1 and 9 < n < 51):
                    seen["\n".join(lines[a : b + 1])].append((i, a, b))
    for places in seen.values():
        for i, a, b in places:
            if any(x < i or (x == i and d < a) for x, _, d in places):
                gone[i].update(range(a, b + 1))
    return {i: "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[i]) for i, text in rows}


def test_whole_passages_equal_brute_force(spark):
    source = random.Random(8)
    pool = ["", "", "", " "] + [prose(k, n) for k, n in enumerate([1, 1, 2, 3, 4, 5, 6, 9, 11, 12, 55] * 2)]
    rows = [(i, "\n".join(source.choices(pool, k=source.randint(1, 14)))) for i in range(120)]
    out = line_dedup.drop_repeated_lines(frame(spark, rows).repartition(4), whole=True).collect()
    assert {r["doc_id"]: r["text"] for r in out} == whole_passages_by_hand(rows)


def test_whole_passages_of_odd_rows(spark, empty):
    assert line_dedup.drop_repeated_lines(empty, whole=True).count() == 0
    rows = [r for r in MESSY if r[0] not in (6, 7)]
    out = line_dedup.drop_repeated_lines(frame(spark, rows), whole=True).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted(rows, key=str)


def test_many_blank_lines_make_few_windows():
    text = (prose(1, 12) + "\n" * 50_000 + prose(2, 3) + "\n" + prose(3, 12)).encode()
    assert sum(b - a for _, a, b in line_dedup.passage_windows(text, 2, 10, 51)) < 10 * len(text)


def test_chunks_do_not_shift():
    lines = [prose(k, 12) for k in range(200)]
    before = {c[0] for c in line_dedup.line_chunks("\n".join(lines).encode(), 2, 2, 2, 10)}
    after = {c[0] for c in line_dedup.line_chunks("\n".join(lines[:90] + ["a new line"] + lines[90:]).encode(), 2, 2, 2, 10)}
    assert len(before & after) >= 0.9 * len(before)


def test_removing_spans():
    assert line_dedup.without("a\nbb\nc", [(2, 4)]) == "a\nc"
    assert line_dedup.without("a\nbb\nc", [(5, 6)]) == "a\nbb"
    assert line_dedup.without("a\nbb\nc", [(0, 6)]) == ""
    assert line_dedup.without("é\nbb\nc", [(0, 2), (3, 5)]) == "c"


def test_counted_characters_follow_the_text(spark):
    rows, _ = passage_rows()
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    assert all(r["n_chars"] == len(r["text"] or "") for r in line_dedup.drop_repeated_lines(docs).collect())


def test_lines_of_no_rows(empty):
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def packed_rows(spark, docs, capacity):
    out = packing.pack(packing.pieces(docs, JSON, PATTERN, capacity), capacity, bucket_pieces=40)
    return [r.asDict() for r in out.collect()]


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing_is_whole_and_gapless(spark, capacity):
    rows = MESSY + [(100 + k, prose(k, 1 + 37 * k % 600)) for k in range(90)]
    got = packed_rows(spark, frame(spark, rows).repartition(3), capacity)
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    want = []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((str(i), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    names = ("piece", "start", "length", "ids_crc32")
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in got) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [a for a, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    least = -(-sum(r["length"] for r in got) // capacity)
    assert len(sequences) <= least + 4


def test_pieces_hold_added_tokens_as_the_library_finds_them(spark):
    mark = "<|endoftext|>"
    texts = [t for _, t in MESSY] + ["a <|endoftext|> b", mark, mark * 2 + " x", f"it{mark}  \n b ", f"x{mark[:-1]}", f"{prose(1, 30)}{mark}'s {mark}"]
    rows = list(enumerate(texts))
    out = packing.pieces(frame(spark, rows).repartition(2), JSON, PATTERN, capacity=1 << 20, with_ids=True, find_added=True).collect()
    tokenizer = Tokenizer.from_file(JSON)
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows}
    assert sum(50256 in ids for ids in want.values()) == 6
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in out} == want


def test_packing_queries_find_added_tokens(spark, tmp_path):
    spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    crc = zlib.crc32(np.array([64, 220, 50256, 275, 0], "<u4").tobytes())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for out in (queries.op3_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.packed(spark, docs, str(tmp_path))):
        assert [(r["length"], r["ids_crc32"]) for r in out.collect()] == [(5, crc)]


def test_search_empties_sequences_that_best_fit_cannot():
    # Best fit of the longest first needs four sequences here; three hold everything.
    sizes = np.array([5, 4, 4, 3, 2, 2, 5, 5])
    first = packing.best_fit(sizes, 10)
    better = packing.improve([[int(sizes[i]) for i in b] for b in first], 10)
    assert sorted(x for b in better for x in b) == sorted(sizes.tolist())
    assert all(sum(b) <= 10 for b in better)
    assert len(better) == 3


def test_search_never_needs_more():
    source = np.random.default_rng(1)
    for _ in range(30):
        sizes = source.integers(1, 101, 80)
        first = packing.best_fit(sizes, 100)
        sequence, offset = packing.pack_sizes(sizes, 100)
        fill = np.bincount(sequence, sizes)
        assert fill.max() <= 100 and len(fill) <= len(first)
        assert all((offset[sequence == s] < 100).all() for s in set(sequence.tolist()))


def test_packing_of_no_rows(spark, empty):
    assert packed_rows(spark, empty, 2048) == []


def fewest(sizes: tuple[int, ...], capacity: int) -> int:
    """The least number of sequences, by trying everything: subsets as bits, tokens in the last open sequence."""
    best = {0: (0, capacity)}
    for chosen in range(1, 1 << len(sizes)):
        found = []
        for i, size in enumerate(sizes):
            if chosen >> i & 1:
                n, fill = best[chosen ^ 1 << i]
                found.append((n, fill + size) if fill + size <= capacity else (n + 1, size))
        best[chosen] = min(found)
    return best[(1 << len(sizes)) - 1][0]


def test_the_packing_search_agrees_with_trying_everything():
    draw = np.random.default_rng(5)
    lost = 0
    for _ in range(40):
        sizes = draw.integers(15, 60, 11)
        packed = packing.improve([[int(sizes[i]) for i in b] for b in packing.best_fit(sizes, 100)], 100)
        lost += len(packed) - fewest(tuple(sizes.tolist()), 100)
    assert lost == 0


def test_the_packing_search_goes_on_until_nothing_moves():
    sizes = np.random.default_rng(3).integers(500, 1001, 4000)
    first = packing.best_fit(sizes, 2048)
    packed = packing.improve([[int(sizes[i]) for i in b] for b in first], 2048)
    assert len(first) == 1619 and len(packed) <= 1556
    assert sorted(x for b in packed for x in b) == sorted(sizes.tolist())
    assert max(map(sum, packed)) <= 2048


def test_partners_are_looked_up_by_room_and_content():
    bins = [[70, [30, 40]], [90, [20, 70]], [95, [5, 10, 80]]]
    ones, twos = packing.Partners(bins, 100, False), packing.Partners(bins, 100, True)
    for i in range(3):
        ones.add(i)
        twos.add(i)
    assert ones.best(30, 0) == (30, 0, 0)
    assert ones.best(38, 0) == (8, 30, 0)
    assert twos.best(20, 0) == (5, 15, 2)
    ones.drop(0)
    assert ones.best(30, 0) == (10, 20, 1)
    assert ones.best(30, 10) == (0, 0, -1)
    assert packing.two_of([5, 10, 80], 90) == [10, 80]
    assert packing.pair_sums([7, 7, 3]) == {10, 14}
