"""Medians, ranking, keyed loading, integrity and ledger against plain Python."""

from __future__ import annotations

import datetime as dt
import random
import statistics
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from toitscope.functions.measures import json_or_null, price_per_m2, share_pct
from toitscope.operators import integrity, keyed, ledger, ranking
from toitscope.operators.medians import amount_counts, amount_stats

SALE = "commune_id string, prix decimal(12,2), surface decimal(10,2)"


def sales(seed: int, number: int) -> list[tuple]:
    """A third of all rows on one key, repeated amounts, NULLs, zero, negative and extreme amounts."""
    rng = random.Random(seed)
    rows = []
    for _ in range(number):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(20)}"
        price = rng.choice([rng.randrange(0, 10**8), rng.randrange(-(10**5), 10**5), 999_999_999_999, 150_000_00])
        surface = None if rng.random() < 0.2 else Decimal(rng.randrange(0, 30_000)) / 100
        rows.append((key, Decimal(price) / 100, surface))
    return [*rows, ("nulls", Decimal(1), None), ("nulls", Decimal(2), None)]


def expected(rows: list[tuple]) -> dict:
    out = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        figures = [len(mine)]
        for place in (1, 2):
            values = [r[place] for r in mine if r[place] is not None]
            figures.append(float(statistics.median(values)) if values else None)
            figures.append((sum(values) / len(values)).quantize(Decimal("1e-6"), "ROUND_HALF_UP") if values else None)
        out[key] = tuple(figures)
    return out


def stats(df, keys, members=None, block=100_000) -> dict:
    counts = amount_counts(df, keys, ["prix", "surface"])
    found = amount_stats(counts, keys, {"prix": block, "surface": 1_000}, members)
    names = ["nb_rows", "prix_median", "prix_mean", "surface_median", "surface_mean"]
    rest = [c for c in found.columns if c not in names]
    return {tuple(r[c] for c in rest): tuple(r[c] for c in names) for r in found.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_medians_match_python(spark, seed):
    rows = sales(seed, 700 + seed)
    got = stats(spark.createDataFrame(rows, SALE), ["commune_id"])
    assert {k[0]: v for k, v in got.items()} == expected(rows)


def test_medians_do_not_depend_on_partitions_or_blocks(spark):
    df = spark.createDataFrame(sales(9, 500), SALE)
    base = stats(df.repartition(1), ["commune_id"])
    assert stats(df.repartition(7), ["commune_id"]) == base
    assert stats(df, ["commune_id"], block=10) == base
    assert stats(df, ["commune_id"], block=10**12) == base


def test_medians_of_overlapping_groups(spark):
    rows = sales(4, 600)
    pairs = [(k, "all") for k in {r[0] for r in rows}]
    pairs += [(k, "some") for k in {r[0] for r in rows} if k in ("hot", "k1", "k2")]
    members = spark.createDataFrame(pairs, "commune_id string, area string")
    got = stats(spark.createDataFrame(rows, SALE), ["commune_id"], members)
    assert got[("all",)] == expected([("x", *r[1:]) for r in rows])["x"]
    some = [("x", *r[1:]) for r in rows if r[0] in ("hot", "k1", "k2")]
    assert got[("some",)] == expected(some)["x"]


def test_first_n_per_group_on_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 5}", i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "dept string, pos int").repartition(9)
    got = ranking.first_n_per_group(df, ["dept"], [F.col("pos")], 50, lanes=4).collect()
    want = [(g, p) for g in {r[0] for r in rows} for p in sorted(p for d, p in rows if d == g)[:50]]
    assert sorted(map(tuple, got)) == sorted(want)
    assert ranking.first_n_per_group(df, ["dept"], [F.col("pos")], None) is df


def test_latest_per_key_keeps_nulls_of_the_last_row(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 5, "y")], "k string, o int, v string")
    got = ranking.latest_per_key(df, ["k"], F.col("o")).collect()
    assert sorted(map(tuple, got)) == [("a", 2, None), ("b", 5, "y")]


EXISTING = [("1", "old", 10, "2020"), ("2", "two", None, "2020")]
REGISTER = "code string, nom string, population int, created string"


def test_upsert_twice_is_upsert_once(spark):
    existing = spark.createDataFrame(EXISTING, REGISTER)
    incoming = spark.createDataFrame([("1", None), ("3", "three")], "code string, nom string")
    once = keyed.upsert(existing, incoming, ["code"], ["nom"], {"created": F.lit("now")})
    want = [("1", None, 10, "2020"), ("2", "two", None, "2020"), ("3", "three", None, "now")]
    assert sorted(map(tuple, once.collect())) == want
    twice = keyed.upsert(once, incoming, ["code"], ["nom"], {"created": F.lit("later")})
    assert sorted(map(tuple, twice.collect())) == want


def test_unique_key_policies(spark):
    schema = "commune_id string, annee int, population int"
    existing = spark.createDataFrame([("1", 2020, 5)], schema)
    incoming = spark.createDataFrame([("1", 2020, 6), ("2", 2020, 7), ("2", 2020, 8)], schema)
    keys, order = ["commune_id", "annee"], F.col("population")
    conflicts = keyed.key_conflicts(existing, incoming, keys).collect()
    assert sorted(map(tuple, conflicts)) == [("1", 2020, 1, True), ("2", 2020, 2, False)]
    with pytest.raises(keyed.KeyConflict):
        keyed.insert_unique(existing, incoming, keys)
    skipped = keyed.insert_unique(existing, incoming, keys, "skip", order)
    assert list(map(tuple, skipped.collect())) == [("2", 2020, 7)]
    updated = keyed.insert_unique(existing, incoming, keys, "update", order)
    assert sorted(map(tuple, updated.collect())) == [("1", 2020, 6), ("2", 2020, 8)]


@pytest.mark.parametrize("chunk", [2, 1_000])
def test_multiset_difference(spark, chunk):
    schema = "a string, b int"
    incoming = [("x", 1)] * 7 + [("y", None)] * 3 + [("z", 3)]
    stored = [("x", 1)] * 2 + [("y", None)] + [("z", 3)] * 4
    got = keyed.not_yet_loaded(
        spark.createDataFrame(incoming, schema), spark.createDataFrame(stored, schema), ["a", "b"], chunk
    )
    assert Counter(map(tuple, got.collect())) == Counter(incoming) - Counter(stored)


def test_rules_and_orphans(spark):
    rows = [
        ("75056", dt.date(2023, 1, 1), 1.0, 1.0, "maison"),
        ("123456", dt.date(2023, 1, 1), 1e10, 1e9, "x" * 51),
        (None, None, 1.0, None, "maison"),
    ]
    schema = "commune_id string, date_transaction date, prix double, surface double, type_bien string"
    checked = integrity.with_violations(spark.createDataFrame(rows, schema), "transactions")
    found = [sorted(r["violations"]) for r in checked.collect()]
    assert found[0] == []
    assert found[1] == ["commune_id_length", "prix_range", "surface_range", "type_bien_length"]
    assert found[2] == ["commune_id_null", "date_transaction_null"]
    parents = spark.createDataFrame([("75056",), ("9",)], "code_insee string")
    marked = integrity.mark_orphans(checked, parents, "commune_id", "code_insee")
    assert [r["_orphan"] for r in marked.orderBy(F.desc_nulls_last("commune_id")).collect()] == [False, True, True]
    good = integrity.loadable(checked, parents, "commune_id", "code_insee").count()
    bad = integrity.orphans(checked, parents, "commune_id", "code_insee").count()
    assert (good, bad) == (1, 2)


def test_energy_label_rule(spark):
    df = spark.createDataFrame([("1", "A", None), ("1", "H", "")], "commune_id string, classe_energetique string, classe_ges string")
    found = [sorted(r["violations"]) for r in integrity.with_violations(df, "dpe").collect()]
    assert found == [[], ["classe_energetique_label", "classe_ges_label"]]


def test_durations_and_latest_runs(spark):
    day = dt.datetime(2024, 3, 31)
    rows = [
        ("1", "a", day.replace(hour=1), day.replace(hour=1, minute=1), "success", 5),
        ("2", "a", day.replace(hour=2), None, "running", 0),
        ("3", "b", dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2, 0, 0, 1, 500_000), "failed", 0),
        ("4", "b", dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 3, 23, 59, 59), "success", 7),
    ]
    schema = (
        "id string, scraper_name string, started_at timestamp_ntz, completed_at timestamp_ntz, status string, "
        "records_processed bigint"
    )
    runs = spark.createDataFrame(rows, schema)
    seconds = {r["id"]: r["duration_seconds"] for r in runs.select("id", ledger.duration()).collect()}
    assert seconds == {"1": 60.0, "2": None, "3": 2.5, "4": 172800.0}
    latest = {r["scraper_name"]: r["status"] for r in ledger.latest_runs(runs).collect()}
    assert latest == {"a": "running", "b": "success"}
    since = ledger.runs_since(runs, F.lit(day).cast("timestamp_ntz"), 7).collect()
    assert [r["id"] for r in since] == ["2", "1"]
    assert [r["id"] for r in ledger.recent_runs(runs, 3).collect()] == ["2", "1", "4"]
    assert ledger.success_ratio(runs).first().asDict() == {"nb_success": 2, "nb_total": 4}
    by_loader = {r["scraper_name"]: tuple(r)[1:] for r in ledger.loader_success(runs).collect()}
    assert by_loader == {"a": (2, 1, 2.5), "b": (2, 1, 3.5)}


def test_small_measures(spark):
    df = spark.createDataFrame(
        [(2.675, 1.0), (10.0, 3.0), (10.0, 0.0), (10.0, -1.0), (None, 1.0), (1.0, 0.001), (1e300, 1e-9), (100.005, 7.0)],
        "p double, s double",
    )
    got = [r[0] for r in df.select(price_per_m2(F.col("p"), F.col("s"))).collect()]
    assert got == [2.68, 3.33, None, None, None, 1000.0, None, 14.29]
    pct = spark.createDataFrame([(1, 3), (1, 800), (5, 5)], "a bigint, b bigint").select(share_pct(F.col("a"), F.col("b")))
    assert [r[0] for r in pct.collect()] == [Decimal("33.33"), Decimal("0.13"), Decimal("100.00")]
    text = spark.range(1).select(
        json_or_null(year=F.lit(2023), department=F.lit("06")).alias("a"), json_or_null(year=F.lit(None).cast("int")).alias("b")
    )
    assert tuple(text.first()) == ('{"year":2023,"department":"06"}', None)


def test_statistics_of_more_rows_than_a_table_can_hold(spark):
    counts = spark.createDataFrame([("a", 0, 1000, 10**12), ("a", 0, 3000, 10**12 + 1), ("b", 0, None, 5)], "k string, measure int, units long, n long")
    rows = {r["k"]: r for r in amount_stats(counts, ["k"], {"prix": 100}).collect()}
    assert (rows["a"]["nb_rows"], rows["a"]["prix_median"], rows["a"]["prix_mean"]) == (2 * 10**12 + 1, 30.0, Decimal("20.000000"))
    assert (rows["b"]["nb_rows"], rows["b"]["prix_median"]) == (5, None)


@pytest.mark.parametrize(("price", "surface", "want"), [(1.0, 1e-7, 1e7), (1.005, 1.0, 1.01), (300000.0, 7.0, 42857.14), (1.0, 0.0, None), (5.0, -1.0, None), (None, 1.0, None), (1e10, 3.0, 3333333333.33)])
def test_price_per_m2_is_one_exact_path(spark, price, surface, want):
    df = spark.createDataFrame([(price, surface)], "p double, s double")
    assert df.select(price_per_m2(F.col("p"), F.col("s"))).first()[0] == want
