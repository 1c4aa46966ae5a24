"""Every registered query against its SQL on the smallest data set."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if "date" in name and not pd.api.types.is_numeric_dtype(frame[name]):
            frame[name] = pd.to_datetime(frame[name])
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, database, name):
    got = comparable(queries()[name](spark, SF_DIR).toPandas())
    want = comparable(database.execute(oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0


def test_every_sql_has_its_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
