"""Queries with SQL give its rows, and every query gives some."""

import glob
import os

import duckdb
import pytest

from skytally.llm.oracles import SQL
from skytally.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_agree(name, spark, sf_dir):
    duck = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(SQL[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(column) for column in df.columns]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    assert sorted((tuple(row) for row in df.collect()), key=repr) == expected and expected


def test_native_queries_run_no_python(spark, sf_dir):
    for name in ("op1_preference_format", "op2_url_filter"):
        text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
