"""Every registered query against its check in DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.check_entries import compare, duck

SF_DIR = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    if name in ORACLE:
        assert compare(df, con, ORACLE[name]) == []
    else:
        assert df.count() > 0
