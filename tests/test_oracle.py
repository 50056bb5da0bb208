import os
import sys

import pytest

import __spark_entry__ as binding
from oracle import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SQL = binding.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(binding.base_queries()) <= set(SQL)


@pytest.mark.parametrize("name", sorted(binding.base_queries()))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, binding.base_queries()[name], SQL[name]) is None


def test_entry(spark):
    assert binding.entry(spark).count() == 7


@pytest.mark.parametrize("absent", ["tallyboard.llm", "corpus_pipeline"])
def test_base_queries_do_without_the_training_data_part(monkeypatch, absent):
    monkeypatch.setitem(sys.modules, absent, None)
    monkeypatch.delitem(sys.modules, "tallyboard.llm.queries", raising=False)
    if absent != "corpus_pipeline":
        monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    assert set(binding.queries()) == set(binding.base_queries()) == set(binding.oracle_sql())
