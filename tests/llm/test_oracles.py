import os

import duckdb
import pandas as pd
import pytest

from mailshape.llm.oracles import ORACLES
from mailshape.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    frames = QUERIES[name](spark, FOLDER).toPandas(), duck.sql(ORACLES[name]).df()
    columns = sorted(frames[1].columns)
    mine, want = (f[columns].sort_values(columns, ignore_index=True) for f in frames)
    assert sorted(frames[0].columns) == columns
    pd.testing.assert_frame_equal(mine, want, check_exact=True)
