"""Classifiers, vectors, archives, licences and the pipeline against plain Python, held-out rows and round trips."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import subprocess
import sys
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from toitscope.llm import boosting, embedding_dedup, labelled, licenses, quality, toxicity, warc
from toitscope.llm.components import components

WORDS = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "en", "ior", "ul")]
RUDE = ["numskull", "dolt", "blockhead", "nitwit"]


def prose(seed: int, n: int) -> str:
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def labelled_rows(n=400):
    rows, labels = [], []
    for k in range(n):
        text, toxic, good = prose(k, 40 + k % 200), int(k % 4 == 0), int(k % 5 != 0)
        if toxic:
            words = text.split()
            words[k % len(words)] = RUDE[k // 4 % 4].capitalize()
            text = " ".join(words)
        if not good:
            text = text.upper().replace(" ", "!! ")
        rows.append((k, text))
        labels.append((k, good, toxic))
    rows += [(None, None), (None, "x"), (9001, ""), (9002, None), (9003, "a" * 300_000), (7, rows[7][1])]
    labels += [(None, 1, 1), (9001, None, None), (9002, 1, 0), (7, 1, 0), (12345, 1, 0)]
    return rows, labels


@pytest.fixture(scope="module")
def marked(spark):
    rows, labels = labelled_rows()
    docs = spark.createDataFrame([(*r, "x", 1.0, 5) for r in rows], "doc_id long, text string, label string, score double, n long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held_out_by_hand(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def test_held_out_rows_are_never_sampled(marked):
    docs, labels = marked
    ids = [r["doc_id"] for r in labelled.sample(docs, labels, "toxic", 10_000).collect()]
    assert ids and not any(held_out_by_hand(i) for i in ids) and len(ids) == len(set(ids))
    got = {r["doc_id"]: r["h"] for r in docs.select("doc_id", labelled.held_out("doc_id").alias("h")).collect()}
    assert got == {i: held_out_by_hand(i) for i in got}


def test_sample_is_bounded_and_the_same_each_time(marked):
    docs, labels = marked
    first, again = ({r["doc_id"] for r in labelled.sample(docs, labels, "toxic", 50).collect()} for _ in range(2))
    assert first == again and 0 < len(first) <= 50


def test_toxicity_on_held_out_rows(marked):
    docs, labels = marked
    model = toxicity.fit(docs, labels)
    scores = docs.select("doc_id", toxicity.score("text", model).alias("s")).collect()
    assert len(scores) == docs.count() and all(0 <= r["s"] <= 1 for r in scores)
    truth = {i: t for i, _, t in labelled_rows()[1] if t is not None}
    judged = [(r["s"] >= 0.5) == truth[r["doc_id"]] for r in scores if r["doc_id"] in truth and held_out_by_hand(r["doc_id"])]
    assert len(judged) > 40 and np.mean(judged) > 0.95


def test_toxic_rows_go_and_all_columns_stay(marked):
    docs, labels = marked
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    gone = set(range(400)) - {r["doc_id"] for r in kept.collect()}
    assert len(gone & set(range(0, 400, 4))) >= 95 and len(gone - set(range(0, 400, 4))) <= 3


def test_toxicity_slices_do_not_matter(monkeypatch):
    model = toxicity.Model(np.sort(toxicity.gram_hashes(toxicity.joined(["numskull dolt"])[0], 4)), np.ones(12), -1.0)
    texts = ["numskull", "", "a dolt, a Numskull!", "x" * 500 + " dolt"]
    whole = model.score(texts)
    monkeypatch.setattr(toxicity, "SLICE", 7)
    assert np.allclose(model.score(texts), whole)
    assert np.allclose([model.score([t])[0] for t in texts], whole)


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 0, 0), (2, 0, 0)]])
def test_classifiers_without_both_classes(spark, labels):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    toxic = [r[0] for r in docs.select(toxicity.score("text", toxicity.fit(docs, marks))).collect()]
    good = [r[0] for r in docs.select(quality.score("text", quality.fit(docs, marks))).collect()]
    assert len(set(toxic)) == len(set(good)) == 1
    assert (toxic[0] > 0.5) == bool(labels and labels[0][2])
    assert (good[0] > 0.5) == (not labels or bool(labels[0][1]))


def test_classifiers_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.drop_toxic(docs, marks).count() == 0
    assert quality.keep_good(docs, marks).count() == 0


def test_quality_on_held_out_rows(marked):
    docs, labels = marked
    forest = quality.fit(docs, labels)
    scores = docs.select("doc_id", quality.score("text", forest).alias("s")).collect()
    truth = {i: q for i, q, _ in labelled_rows()[1] if q is not None}
    judged = [(r["s"] >= 0.3) == truth[r["doc_id"]] for r in scores if r["doc_id"] in truth and (r["doc_id"] or 999) < 400 and held_out_by_hand(r["doc_id"])]
    assert len(judged) > 40 and np.mean(judged) > 0.95
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 300 <= kept.count() <= 340


def test_statistics_are_finite():
    for text in ("", " ", "\n\n", "a", "é" * 10, "!!!", "x" * 10_000, "\x00\x00", "A B\nA B"):
        found = quality.statistics(text)
        assert len(found) == quality.STATISTICS and np.isfinite(found).all()


def test_flattened_trees_equal_a_walk():
    source = np.random.default_rng(2)
    x = source.normal(size=(300, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = boosting.fit(x, y, trees=30)

    def walk(row):
        total = forest.bias
        for node in forest.roots:
            while forest.left[node] != node:
                side = forest.left if row[forest.feature[node]] <= forest.cut[node] else forest.right
                node = side[node]
            total += forest.value[node]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(forest.score(x), [walk(row) for row in x])
    assert ((forest.score(x) > 0.5) == y).mean() > 0.97


def vectors_by_hand(rows, threshold):
    unit = {}
    for k, (_, vector, label) in enumerate(rows):
        if label is not None and vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector):
            v = np.array(vector, float)
            unit[k] = (label, v)
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (la, a) in unit.items():
        for j, (lb, b) in unit.items():
            if i < j and la == lb and len(a) == len(b) and a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = defaultdict(list)
    for k, (i, _, _) in enumerate(rows):
        least[find(k)].append(i)
    least = {k: min([x for x in v if x is not None], default=None) for k, v in least.items()}
    return sorted((str(r[0]), links[k], str(least[find(k)]), r[0] == least[find(k)]) for k, r in enumerate(rows))


def vector_rows():
    source = np.random.default_rng(8)
    rows = [(k, source.normal(size=12).tolist(), int(k % 3)) for k in range(300)]
    for k in range(60):
        rows.append((1000 + k, (np.array(rows[k % 7][1]) + source.normal(size=12) * 0.08).tolist(), k % 7 % 3))
    centre = source.normal(size=12)
    rows += [(2000 + k, (centre + source.normal(size=12) * 0.05).tolist(), 1) for k in range(200)]
    rows += [(3000 + k, centre.tolist(), 1) for k in range(50)] + [(3100, (2 * centre).tolist(), 1)]
    rows += [(4000, centre.tolist(), None), (4001, None, 1), (4002, [], 1), (4003, [0.0] * 12, 1), (None, centre.tolist(), 1)]
    rows += [(4004, [float("nan")] * 12, 1), (4005, [None] + [1.0] * 11, 1), (4006, [float("inf")] * 12, 1)]
    return rows + [(4007, [1.0, 2.0], 1), (4008, [2.0, 4.0], 1), (4009, [-0.0, 1.0], 2), (4010, [0.0, 1.0], 2), (0, rows[0][1], 0)]


@pytest.mark.parametrize(("cell", "block"), [(2048, 2048), (20, 30)])
def test_vector_links_equal_brute_force(spark, cell, block):
    rows = vector_rows()
    frame = spark.createDataFrame(
        [(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<double>, label int, node int, n int, cell string"
    )
    got = embedding_dedup.near_vectors(frame.repartition(4), cell=cell, block=block).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in got) == vectors_by_hand(rows, 0.98)


def test_vectors_of_no_rows(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_vectors(frame).count() == 0


def test_components_of_a_path_a_star_and_a_ring(spark):
    path = [(i, i + 1) for i in range(100, 180)]
    star = [(500, 500 + k) for k in range(1, 60)]
    ring = [(700 + k, 700 + (k + 1) % 9) for k in range(9)]
    edges = spark.createDataFrame(path + star + ring + [(5, 5), (1, None), (501, 500)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{k: 100 for k in range(100, 181)}, **{k: 500 for k in range(500, 560)}, **{k: 700 for k in range(700, 709)}}
    assert components(edges.where("false")).count() == 0


PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (3, None, None),
    (4, "http://a/4 with\r\nbreak", ""),
    (5, "http://a/5", "é\r\n\r\nWARC/1.1\r\n" * 50),
    (6, "http://a/6", "z" * 400_000),
    (None, "http://a/n", "<p>one</p>"),
    (None, "http://a/m", "alone"),
    (7, "http://a/7", "<p>one</p>"),
    (7, "http://a/7", "<p>one</p>"),
]


@pytest.mark.parametrize("least", [0, 1])
def test_archives_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, "x", 1) for r in PAGES], "page_id long, url string, html string, digest string, frame int")
    index = warc.write_archives(pages.repartition(2), least_revisit_bytes=least, frame_bytes=1000)
    rows = [r.asDict() for r in warc.read_records(index).collect()]
    first = {}
    for i, _, html in sorted(PAGES, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", i)
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        revisit = len(data) >= least and first[html or ""] != i
        want.append((str(i), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", str(first[html or ""] if revisit else None)))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(tuple(str(r[n]) if n in ("page_id", "refers_to") else r[n] for n in names) for r in rows) == sorted(want)
    payloads = {(r["page_id"], bytes(r["payload"]).decode()) for r in rows if r["payload"] is not None}
    assert ("5", PAGES[4][2]) in payloads and ("6", PAGES[5][2]) in payloads
    assert next(r["url"] for r in rows if r["page_id"] == "4") == "http://a/4%20with%0D%0Abreak"


def test_one_record_by_its_place(spark):
    pages = spark.createDataFrame([(k, f"http://a/{k}", f"page {k} " * 40) for k in range(200)], "page_id long, url string, html string")
    index = warc.write_archives(pages, frame_bytes=2000, archive_bytes=3000)
    assert index.select("file").distinct().count() > 1 and index.agg(F.max("frame")).first()[0] > 0
    got = warc.read_records(index.where("page_id = 137")).collect()
    assert [bytes(r["payload"]).decode() for r in got] == ["page 137 " * 40]


def test_archives_are_readable_from_end_to_end(spark):
    import io

    import zstandard

    pages = spark.createDataFrame([(k, "http://a", f"page {k} " * 9) for k in range(50)], "page_id long, url string, html string")
    index = warc.write_archives(pages.coalesce(1), frame_bytes=1000)
    files, path = warc.file_system(index.first()["file"])
    data = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(files.open_input_file(path).read()), read_across_frames=True).read()
    assert data.count(b"WARC/1.1\r\nWARC-Type: response") == 50


WRITE_AND_END = """
import sys
from toitscope import build_session
from toitscope.llm import warc
shared, folder = sys.argv[1:]
spark = build_session("ends", "local[2]", {"spark.checkpoint.dir": shared, "spark.ui.enabled": "false"})
for start in (0, 50):
    pages = spark.createDataFrame([(k, f"http://a/{k}", f"page {k}") for k in range(start, start + 50)], "page_id long, url string, html string")
    warc.write_archives(pages, folder=folder)
warc.write_archives(pages)
spark.stop()
"""


def test_archives_of_a_named_folder_outlive_the_session(spark, tmp_path):
    folder, shared = tmp_path / "kept", tmp_path / "shared"
    folder.mkdir()
    (folder / "other.txt").write_text("not an archive")
    root = str(Path(corpus_pipeline.__file__).parent)
    subprocess.run([sys.executable, "-c", WRITE_AND_END, str(shared), str(folder)], cwd=root, check=True, timeout=120)
    left = lambda: [*shared.rglob("*.warc.zst"), *shared.rglob("*.parquet")]
    until = time.time() + 20
    while left() and time.time() < until:  # Java ends, and deletes, a little after Python
        time.sleep(0.2)
    assert not left()
    assert (folder / "other.txt").read_text() == "not an archive"
    got = warc.read_records(warc.read_index(spark, str(folder))).collect()
    assert sorted((int(r["page_id"]), bytes(r["payload"]).decode()) for r in got) == [(k, f"page {k}") for k in range(100)]


def test_pages_of_no_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_records(warc.write_archives(pages)).count() == 0


def weigh(texts, least=licenses.LEAST):
    vocabulary = {t for _, x in licenses.TEMPLATES for t in licenses.terms(x)}
    df = Counter(t for x in texts for t in set(licenses.terms(x or "")))
    n = len(texts)
    idf = lambda t: math.log((1 + n) / (1 + df[t])) + 1 if t in vocabulary else math.log(1 + n) + 1
    vector = lambda x: {t: c * idf(t) for t, c in Counter(licenses.terms(x)).items()}
    norm = lambda v: math.sqrt(sum(w * w for w in v.values()))

    def best(x):
        v, found = vector(x), []
        for name, template in licenses.TEMPLATES:
            u = vector(template)
            cosine = round(sum(w * u.get(t, 0) for t, w in v.items()) / max(1e-300, norm(u) * norm(v)), 6)
            if cosine >= least:
                found.append((-cosine, name))
        return min(found, default=None)

    return best


FILES = [
    (1, "LICENSE", "All rights reserved."),
    (2, "a/LICENSE.txt", "intro\nLicensed under the Apache License, Version 2.0.\nmore"),
    (3, "a/b/c/x.txt", prose(1, 30)),
    (4, "a/b/y.txt", "Foo\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0 maybe"),
    (5, "d/z.txt", prose(2, 30)),
    (6, None, "Released under the MIT license"),
    (7, None, None),
    (None, "a/q.txt", ""),
    (8, "ab/r.txt", "the license of the work is of the version"),
    (9, "a/b/COPYING", prose(3, 40)),
    (9, "a/b/COPYING", prose(3, 40)),
]


def test_licences_equal_brute_force(spark):
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in FILES], "doc_id long, path string, text string, license string, row int, term string")
    best = weigh([t for _, _, t in FILES])
    own = {}
    for k, (_, path, text) in enumerate(FILES):
        segments = (text or "").split("\n")
        if path and licenses.re.search(licenses.LICENCE_FILE, path):
            segments.append(text or "")
        own[k] = min([b for s in segments if (b := best(s))], default=None)
    given = defaultdict(list)
    for k, (_, path, _) in enumerate(FILES):
        if path and own[k] and licenses.re.search(licenses.LICENCE_FILE, path):
            given[path.rpartition("/")[0]].append((*own[k], path))
    want = []
    for k, (i, path, _) in enumerate(FILES):
        if own[k]:
            want.append((str(i), str(path), own[k][1], -own[k][0], "own", str(path)))
            continue
        folder, gift = None if path is None else path.rpartition("/")[0], None
        while folder is not None and gift is None:
            gift = min(given[folder]) if folder in given else None
            folder = folder.rpartition("/")[0] if folder else None
        want.append((str(i), str(path), gift[1], -gift[0], "inherited", gift[2]) if gift else (str(i), str(path), None, None, "none", "None"))
    got = [(str(r["doc_id"]), str(r["path"]), r["license"], r["similarity"], r["origin"], str(r["license_path"])) for r in licenses.scan(frame).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[2] for r in got} >= {"Apache-2.0", "MIT", "Proprietary"}


def test_a_line_without_anchors_is_too_far():
    source = random.Random(4)
    weights = {f"t{k}": source.uniform(1, 9) for k in range(12)}
    anchors = licenses.anchors_of(weights, 0.6)
    rest = math.sqrt(sum(w * w for t, w in weights.items() if t not in anchors))
    assert anchors and rest / math.sqrt(sum(w * w for w in weights.values())) < 0.6


def test_licences_of_no_rows(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] > 0.5 * sizes[0]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_pipeline_of_messy_rows(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, prose(1, 50), None, "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 4
