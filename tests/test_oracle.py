"""Every registered tree query against DuckDB on the same tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from boughwork.plans import queries as trees


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def rows(frame: pd.DataFrame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(map(tuple, frame.astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", list(trees.queries()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = rows(trees.queries()[name](spark, sf_dir).toPandas())
    want = rows(duck.execute(trees.oracle_sql()[name]).df())
    assert got == want
    assert got[1]
