"""Every registered query against its SQL oracle (DuckDB) on the smallest testdata."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

TRAINING = set(E._training_queries()[0])  # tested in tests/llm
QUERIES = {k: v for k, v in E.queries().items() if k not in TRAINING}
SQL = {k: v for k, v in E.oracle_sql().items() if k not in TRAINING}


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["complaint_type", "complaint_count", "avg_resolution_hours"]
    assert 0 < len(rows) <= 10
