import pytest

import __spark_entry__ as binding
from oracle import compare, duck
from tallyboard.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], SQL[name]) is None


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(binding.queries())
    assert set(SQL) <= set(binding.oracle_sql())
