"""Line breaks in quoted fields, in files that are read in splits, against the csv module."""

from __future__ import annotations

import csv
import io
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from queries import spark as queries
from toitscope.operators.storage import read_table
from toitscope.plans import loading
from toitscope.schemas import POPULATION_SOURCE, TRANSACTION_COLUMNS
from toitscope.sources import quoted
from toitscope.sources.delimited import read_delimited
from toitscope.sources.quoted import FLIP, INSIDE, KEEP, OUTSIDE, effect
from toitscope.streaming.incremental import ingest_transactions


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_effect_of_a_line(spark):
    lines = {
        "a;b": KEEP, 'a;"b': FLIP, 'b";c': OUTSIDE, 'a;"b";c': OUTSIDE, 'x "" y': KEEP, '5" pipe;c': OUTSIDE,
        'end";"new': INSIDE, '"': FLIP, "": KEEP, 'a;"b ""x"" y': FLIP,
    }
    df = spark.createDataFrame([(k, v) for k, v in lines.items()], "line string, want int")
    wrong = df.withColumn("got", effect(F.col("line"), ";")).where("got != want").collect()
    assert wrong == []


def messy(seed, n):
    draw = random.Random(seed)
    fields = ["x", "", "two\nlines", "a\n\n\nb", 'say "so"\nagain', ";", 'q"', "é\n", "plain " * 9, "end\n"]
    return [[f"{i}", draw.choice(fields) if draw.random() < 0.3 else "p", draw.choice(fields)] for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_records_agree_with_csv(spark, tmp_path, small_splits, seed):
    rows = messy(seed, 900)
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(2):
        out = io.StringIO()
        writer = csv.writer(out, delimiter=";", lineterminator="\n")
        writer.writerow(["COM", "PMUN", "X"])
        writer.writerows(rows[part::2])
        (folder / f"{part}.csv").write_text(out.getvalue())
    got = read_delimited(spark, str(folder), POPULATION_SOURCE, quoted_breaks=True)
    assert spark.read.text(str(folder)).rdd.getNumPartitions() > 5
    assert got.where("_damage IS NOT NULL").count() == 0
    # Blank fields are null, as in any delimited read here.
    assert sorted((r["COM"], r["PMUN"] or "") for r in got.collect()) == sorted((r[0], r[1]) for r in rows)
    order = [r["COM"] for r in got.where(F.col("_pos.file").endswith("0.csv")).orderBy("_pos").collect()]
    assert order == [r[0] for r in rows[::2]]


def test_damage_stays_where_it_is(spark, write, small_splits):
    filler = [f"{i};{i}" for i in range(1000, 1400)]
    write("in", "a.csv", "COM;PMUN;X", "1;\"a\nb\";x", "2;only", "3;5\" pipe;x", "", "4;y;z;surplus", *[f"{x};" for x in filler])
    rows = read_delimited(spark, write("in", "b.csv", "COM;PMUN;X", "5;\"never closed;x", *[f"{x};x" for x in filler] * 4), POPULATION_SOURCE, quoted_breaks=True)
    found = {r["COM"]: (r["PMUN"], r["_damage"]) for r in rows.where(F.col("_pos.file").endswith("a.csv")).collect()}
    assert found["1"] == ("a\nb", None)
    assert found["2"] == ("only", "short_row")
    assert found["3"] == ('5" pipe', None)
    assert found["4"] == ("y", None)
    assert len(found) == 404
    lost = rows.where(F.col("_pos.file").endswith("b.csv"))
    assert lost.groupBy("_damage").count().collect() == [("open_quote", 1601)]


def test_another_header_is_an_error(spark, write):
    write("in", "a.csv", "COM;PMUN", "1;2")
    folder = write("in", "b.csv", "PMUN;COM", "1;2")
    with pytest.raises(Exception, match="header differs"):
        read_delimited(spark, folder, POPULATION_SOURCE, quoted_breaks=True).collect()


def test_sales_with_line_breaks_by_batch_and_stream(spark, write, tmp_path):
    warehouse, root = str(tmp_path / "warehouse"), str(tmp_path / "in")
    write("in/communes", "a.csv", "com_code,com_nom,dep_code,reg_nom,latitude,longitude", '06088,"Nice\n(ville)",06,PACA,,')
    loading.load_communes(spark, root, warehouse, quoted_breaks=True)
    assert read_table(spark, warehouse, "communes").first()["nom"] == "Nice\n(ville)"
    lines = ["|".join(TRANSACTION_COLUMNS)] + [f'06088|2023-05-0{i}|{i}|Maison|50|3|Vente|1|"RUE\nX"|06000' for i in range(1, 5)]
    write("in/transactions/year=2023/dept=06", "a.csv", *lines)
    assert loading.load_transactions(spark, root, warehouse, quoted_breaks=True).rows_written == 4
    write("drops", "a.csv", *lines)
    ingest_transactions(spark, str(tmp_path / "drops"), warehouse, str(tmp_path / "checkpoint"), quoted_breaks=True)
    stored = read_table(spark, warehouse, "transactions").collect()
    assert len(stored) == 8 and all("\n" in r["adresse"] for r in stored)


def test_runs_are_small_whatever_the_block(spark, tmp_path, monkeypatch):
    """Records that go on over several runs of one block; no window holds more lines than a run has."""
    monkeypatch.setattr(quoted, "RUN_BITS", 3)
    sizes = []
    seen = quoted._begins
    monkeypatch.setattr(quoted, "_begins", lambda run: sizes.extend(r["count"] for r in run.groupBy(*quoted.RUN).count().collect()) or seen(run))
    rows = messy(7, 200)
    for number in (3, 90, 91, 199):
        rows[number][2] = "\n".join(f"line {i} of {number}" for i in range(7 + number))
    out = io.StringIO()
    writer = csv.writer(out, delimiter=";", lineterminator="\n")
    writer.writerow(["COM", "PMUN", "X"])
    writer.writerows(rows)
    (tmp_path / "a.csv").write_text(out.getvalue())
    source = replace(POPULATION_SOURCE, optional=["X"])
    got = read_delimited(spark, str(tmp_path / "a.csv"), source, quoted_breaks=True)
    assert [[r["COM"], r["PMUN"] or "", r["X"] or ""] for r in got.orderBy("_pos").collect()] == rows
    assert got.select("_pos.block").distinct().count() == 1
    assert len(sizes) > 80 and max(sizes) <= 8


def test_a_larger_table_has_more_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "RECORDS_PER_FILE", 50)
    orders = spark.range(1000).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "'1-URGENT' AS o_orderpriority", "1.5D AS o_totalprice"
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    paths = []
    reader = queries.read_delimited
    monkeypatch.setattr(queries, "read_delimited", lambda s, path, *a, **o: paths.append(path) or reader(s, path, *a, **o))
    got = queries.REGISTRY["multiline_csv"](spark, str(tmp_path)).collect()
    assert len(got) == 1000 and {r["note"] for r in got} == {"first\n\nsecond"}
    by_file = spark.read.text(paths[0]).groupBy(F.input_file_name()).count().collect()
    assert len(by_file) == 20 and max(r["count"] for r in by_file) == 151
