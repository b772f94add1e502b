"""Commits: several writers, several tables, repeated and failed work."""

from __future__ import annotations

import threading
from datetime import date
from decimal import Decimal

import pytest

from toitscope.operators.commits import CommitConflict, as_of, in_transaction, latest, put_if_absent, transaction
from toitscope.operators.storage import append, read_table, replace, with_defaults
from toitscope.schemas import TABLES


@pytest.fixture
def warehouse(tmp_path):
    return str(tmp_path / "warehouse")


def sales(spark, *prices):
    rows = [("06088", date(2023, 5, 1), Decimal(p), "maison") for p in prices]
    found = spark.createDataFrame(rows, "commune_id string, date_transaction date, prix decimal(12,2), type_bien string")
    return with_defaults(found, "transactions")


def communes(spark, *codes):
    rows = [(c, "n", "06", "r") for c in codes]
    return with_defaults(spark.createDataFrame(rows, "code_insee string, nom string, dept string, region string"), "communes")


def prices(spark, warehouse):
    return sorted(int(r["prix"]) for r in read_table(spark, warehouse, "transactions").collect())


def elsewhere(work):
    """Another writer: a thread of its own, outside the running transaction."""
    failed = []

    def run():
        try:
            work()
        except BaseException as error:
            failed.append(error)

    thread = threading.Thread(target=run)
    thread.start()
    thread.join()
    if failed:
        raise failed[0]


def test_an_append_during_a_replace_is_kept(spark, warehouse):
    append(sales(spark, 1), warehouse, "transactions")
    with transaction(spark, warehouse):
        rewritten = read_table(spark, warehouse, "transactions").drop("year")
        replace(rewritten, warehouse, "transactions")
        elsewhere(lambda: append(sales(spark, 2), warehouse, "transactions"))
    assert prices(spark, warehouse) == [1, 2]


def test_of_two_replaces_one_is_done_anew(spark, warehouse):
    append(sales(spark, 1), warehouse, "transactions")
    seen = []

    def raise_prices():
        stored = read_table(spark, warehouse, "transactions").drop("year")
        seen.append(stored.count())
        replace(stored.selectExpr("* except (prix)", "cast(prix + 10 as decimal(12,2)) as prix"), warehouse, "transactions")
        if len(seen) == 1:
            elsewhere(lambda: in_transaction(spark, warehouse, raise_prices_elsewhere))

    def raise_prices_elsewhere():
        stored = read_table(spark, warehouse, "transactions").drop("year")
        replace(stored.selectExpr("* except (prix)", "cast(prix * 2 as decimal(12,2)) as prix"), warehouse, "transactions")

    in_transaction(spark, warehouse, raise_prices)
    assert len(seen) == 2
    assert prices(spark, warehouse) == [12]
    with pytest.raises(CommitConflict):
        with transaction(spark, warehouse):
            replace(sales(spark, 0), warehouse, "transactions")
            elsewhere(lambda: replace(sales(spark, 5), warehouse, "transactions"))
    assert prices(spark, warehouse) == [5]


def test_tables_show_together_or_not_at_all(spark, warehouse):
    with transaction(spark, warehouse):
        append(communes(spark, "06088"), warehouse, "communes")
        append(sales(spark, 1, 2), warehouse, "transactions")
        assert prices(spark, warehouse) == [1, 2]
        seen = []
        elsewhere(lambda: seen.append((latest(spark, warehouse).number, prices(spark, warehouse))))
        assert seen == [(0, [])]
    assert (latest(spark, warehouse).number, sorted(latest(spark, warehouse).tables)) == (1, ["communes", "transactions"])
    with pytest.raises(ZeroDivisionError):
        with transaction(spark, warehouse):
            append(sales(spark, 3), warehouse, "transactions")
            raise ZeroDivisionError
    assert prices(spark, warehouse) == [1, 2]


def test_an_error_undoes_its_part_alone(spark, warehouse):
    done = []
    with transaction(spark, warehouse) as outer:
        outer.after.append(lambda: done.append("outer"))
        append(sales(spark, 1), warehouse, "transactions")
        with pytest.raises(ZeroDivisionError):
            with transaction(spark, warehouse) as inner:
                inner.after.append(lambda: done.append("inner"))
                append(sales(spark, 2), warehouse, "transactions")
                raise ZeroDivisionError
        assert done == []
    assert prices(spark, warehouse) == [1]
    assert done == ["outer"]


def test_a_unique_key_makes_appends_exclusive(spark, warehouse):
    append(communes(spark, "1"), warehouse, "communes")
    with pytest.raises(CommitConflict):
        with transaction(spark, warehouse):
            append(communes(spark, "2"), warehouse, "communes")
            elsewhere(lambda: append(communes(spark, "2"), warehouse, "communes"))
    assert read_table(spark, warehouse, "communes").count() == 2


def test_a_repeated_load_replaces_what_it_left(spark, warehouse):
    append(sales(spark, 1, 2), warehouse, "transactions", "load-a")
    append(sales(spark, 3), warehouse, "transactions", "load-b")
    before = read_table(spark, warehouse, "transactions")
    append(sales(spark, 7), warehouse, "transactions", "load-a")
    assert prices(spark, warehouse) == [3, 7]
    # Whoever began with the earlier commit keeps to it.
    assert sorted(int(r["prix"]) for r in before.collect()) == [1, 2, 3]
    old = read_table(spark, warehouse, "transactions", at=as_of(spark, warehouse, 1))
    assert sorted(int(r["prix"]) for r in old.collect()) == [1, 2]


def test_many_writers_at_once_lose_nothing(spark, warehouse):
    work = [threading.Thread(target=append, args=(sales(spark, i), warehouse, "transactions")) for i in range(6)]
    for thread in work:
        thread.start()
    for thread in work:
        thread.join()
    assert prices(spark, warehouse) == list(range(6))
    assert latest(spark, warehouse).number == 6


def test_a_number_is_taken_once(spark, warehouse):
    assert put_if_absent(spark, f"{warehouse}/x/1.json", "first")
    assert not put_if_absent(spark, f"{warehouse}/x/1.json", "second")
    assert spark.read.text(f"{warehouse}/x/1.json").first()[0] == "first"


def test_a_table_without_rows_or_commits(spark, warehouse):
    assert latest(spark, warehouse).number == 0
    assert read_table(spark, warehouse, "dpe").columns == TABLES["dpe"].names
    append(sales(spark), warehouse, "transactions")
    assert prices(spark, warehouse) == []
