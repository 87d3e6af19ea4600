"""Every registered query against its SQL, on the smallest tables."""

import os
import re
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import rows_of
from registry import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SURVEY_IDS = {
    "SC": 10, "SK": 6, "PR": 7, "FI": 14, "JN": 4, "AG": 8, "DD": 3, "SO": 5, "UN": 2, "ST": 17, "JB": 5,
}

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_operator_is_registered_and_checked():
    have = {re.match(r"[a-z]+\d+", key).group() for key in catalog.QUERIES}
    want = {f"{prefix.lower()}{n}" for prefix, count in SURVEY_IDS.items() for n in range(1, count + 1)}
    assert have == want
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, db, key):
    df = queries()[key](spark, FOLDER)
    result = db.execute(oracle_sql()[key])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
