"""Every registered query against its SQL on the same files."""

import pytest

import __spark_entry__ as entry
from parity import QUERIES, SQL
from parity.compare import connect, differences


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, folder, duck, name):
    count, found = differences(QUERIES[name](spark, folder), duck, SQL[name])
    assert not found, "\n".join(found)


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 32 and df.count() > 0
    # every query of the library has its SQL; queries of the corpus subpackage may lack one and are tested in tests/llm
    assert set(SQL) == set(QUERIES) and set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
