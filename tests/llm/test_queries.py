"""Registered queries against their DuckDB twins, and the rules all of them share."""

import os

import pytest

from conftest import PARITY_SF
from parity import compare
from shoplens.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, duck_parity, name):
    problems, n_spark, n_duck = compare(queries.QUERIES[name](spark, PARITY_SF), duck_parity, queries.SQL[name])
    assert not problems, problems
    assert n_spark == n_duck > 0


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_nothing_else_imports_the_package():
    root = os.path.dirname(os.path.dirname(queries.__file__))
    for folder, _, names in os.walk(root):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    assert "shoplens.llm" not in open(os.path.join(folder, n)).read()
