"""Every registered query that has SQL, against a second engine on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_entry(spark):
    assert entry(spark).count() == 6


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, duck, name):
    got = queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    ours = [tuple(r) for r in got.select(*columns).collect()]
    theirs = duck.execute(oracle_sql()[name])
    assert sorted(d[0] for d in theirs.description) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = duck.execute(f"SELECT {quoted} FROM ({oracle_sql()[name]})").fetchall()
    assert sorted(ours, key=repr) == sorted(expected, key=repr)
