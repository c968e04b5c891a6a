"""Every registered query against its DuckDB oracle (driver gate, run locally
on sf0.001 for speed; the driver runs it on sf0.01)."""

import pytest

from conftest import SF_SMALL
from harness import compare

import __spark_entry__ as E
from tallyspark.plans import registry as REG

QUERIES = {name: query for name, query in E.queries().items() if name in REG.QUERIES}
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name in REG.QUERIES}


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE[name])
    assert r["columns_match"], r
    assert r["rows_match"], r
    assert r["hash_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == E.entry(spark).columns
