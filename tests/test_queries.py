"""Every registered query against its oracle SQL."""

import pytest

import __spark_entry__ as entry_module
from jobweave.verify.check import compare, oracle_connection
from jobweave.verify.registry import QUERIES

GROUPS = {"a": 19, "b": 16, "c": 45, "d": 14, "e": 13, "f": 12, "g": 4, "h": 4, "j": 12, "k": 4, "l": 3, "n": 18}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return oracle_connection(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle, sf_dir, name):
    assert compare(spark, oracle, name, sf_dir)[0].startswith("ok")


def test_every_operator_has_a_query():
    names = set(QUERIES)
    wanted = {f"{g}{i}" for g, n in GROUPS.items() for i in range(1, n + 1)}
    assert {n.split("_")[0] for n in names} == wanted
    assert names <= set(entry_module.oracle_sql()) and names <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "salary_median_annual" in df.columns
