import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from mailshape.plans.oracles import ORACLES
from mailshape.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ["documents", "labels", "pages", "conversations", "embeddings", "benchmark"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    columns = sorted(frame.columns)
    return frame[columns].sort_values(columns, ignore_index=True)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    mine = normal(QUERIES[name](spark, FOLDER).toPandas())
    want = normal(duck.sql(ORACLES[name]).df())
    pd.testing.assert_frame_equal(mine, want, check_exact=True)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_without_sql_is_a_model_run():
    assert set(QUERIES) - set(ORACLES) == {
        "model_keyword", "model_tfidf_unigram", "model_logistic", "model_svm", "model_word2vec",
        "cross_validation", "model_comparison"}
