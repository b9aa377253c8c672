"""Every registered query against its SQL twin in DuckDB."""

import pytest
from compare import connect, oracle_rows, spark_rows

import __spark_entry__ as entry_point
from marketbars.plans.oracle import ORACLE
from marketbars.plans.registry import QUERIES


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, oracle, name):
    frame = entry_point.queries()[name](spark, sf_dir)
    sql = entry_point.oracle_sql()[name]
    names = [d[0] for d in oracle.execute(sql).description]
    assert sorted(frame.columns) == sorted(names)
    got = spark_rows(frame)
    assert got == oracle_rows(oracle, sql)
    assert got


def test_entry(spark, sf_dir):
    assert entry_point.entry(spark).count() > 0
