import glob
import os

import duckdb
import pandas as pd

from boughwork.llm import queries


def _rows(frame: pd.DataFrame):
    frame = frame[sorted(frame.columns)]
    plain = lambda v: None if v is None or v is pd.NA or v != v else v
    return list(frame.columns), sorted((tuple(plain(v) for v in r) for r in frame.astype(object).itertuples(index=False)), key=str)


def assert_query_equals_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got, want = _rows(queries.queries()[name](spark, sf_dir).toPandas()), _rows(connection.execute(queries.oracle_sql()[name]).df())
    assert got[0] == want[0] and len(got[1]) == len(want[1]) > 0
    assert all(a == b for a, b in zip(got[1], want[1]))
