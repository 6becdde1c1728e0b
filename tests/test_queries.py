"""Every registered query beside its SQL."""

import pytest

import __spark_entry__ as entry
from oracle_check import check, duck

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["slice_label", "rank", "term", "score"]


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, sf_dir, name):
    result, rows = check(spark, con, sf_dir, name, entry.queries()[name], ORACLE.get(name))
    assert result in ("ok", "no sql")
    # at the smallest scale no week holds 15 documents, few neighbours exist and nothing is common to most weeks
    assert rows > 0 or name in ("t10_min_docs", "a13_stable", "j11_core_documents")
