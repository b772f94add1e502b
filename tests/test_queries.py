"""Every registered query against its SQL in DuckDB on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import comparable, normal
from queries.spark import REGISTRY

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_its_sql():
    assert set(REGISTRY) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    df = queries()[name](spark, str(FOLDER))
    got = comparable(pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns))
    cursor = duck.execute(oracle_sql()[name])
    head = [c[0] for c in cursor.description]
    want = comparable(pd.DataFrame(cursor.fetchall(), columns=head))
    assert sorted(head) == sorted(df.columns)
    assert [tuple(map(normal, row)) for row in got] == [tuple(map(normal, row)) for row in want]
