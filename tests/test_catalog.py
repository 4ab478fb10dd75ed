"""Every registered query against its check SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from verify import check

SF = os.environ.get("WARDLINE_TEST_SF", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_checks_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_check(spark, con, name):
    status, note, _ = check(spark, con, SF, name, QUERIES[name], ORACLES[name])
    assert status == "OK", note
