"""Every query that has SQL against it, and the shape of all."""

import pytest

import __spark_entry__ as entry_module
from jobweave.llm.queries import ORACLE, QUERIES
from jobweave.llm.testing import compare_rows
from jobweave.verify.check import oracle_connection


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, oracle, sf_dir, name):
    assert compare_rows(QUERIES[name](spark, sf_dir), oracle.sql(ORACLE[name])) == ""


def test_queries_are_registered():
    assert set(QUERIES) <= set(entry_module.queries())
    assert {n.split("_")[0] for n in QUERIES} >= {f"op{i}" for i in range(1, 11)} | {"pipeline"}
