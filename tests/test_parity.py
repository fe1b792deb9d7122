"""Every registered query against its DuckDB twin (the driver's gate)."""

import pytest

import __spark_entry__ as entry_mod
from conftest import PARITY_SF
from parity import compare

from shoplens.plans import registry
from shoplens.streaming import runs

# the optional subpackage's queries are tested beside it
QUERIES = {**registry.QUERIES, **runs.STREAM_QUERIES}
SQL = {k: v for k, v in entry_mod.oracle_sql().items() if k in QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 24
    assert df.columns == ["hour", "today", "yesterday"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_parity, name):
    df = QUERIES[name](spark, PARITY_SF)
    problems, n_spark, n_duck = compare(df, duck_parity, SQL[name])
    assert not problems, problems
    assert n_spark == n_duck
