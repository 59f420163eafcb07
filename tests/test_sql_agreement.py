"""Every registered query gives the rows its SQL gives."""

import glob
import os

import duckdb
import pytest

from skytally.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_rows_agree(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(SQL[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(column) for column in df.columns]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    found = sorted((tuple(row) for row in df.collect()), key=repr)
    assert found, "an empty result proves nothing"
    assert found == expected
    assert [[type(v) for v in row] for row in found] == [[type(v) for v in row] for row in expected]
