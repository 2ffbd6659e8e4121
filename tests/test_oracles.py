"""Every registered query against its DuckDB SQL, on whole tables."""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
from postloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert QUERIES.keys() <= entry.queries().keys()
    assert QUERIES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, sf_dir, name):
    problem, _, _ = compare(spark, con, sf_dir, name)
    assert problem == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 10
