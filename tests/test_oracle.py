"""Every query with an oracle, against DuckDB on the smallest data."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
#: These run the whole chain with 400 trees, which takes minutes at any size.
WHOLE_CHAIN = {"validate_schemas", "validate_disruption"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in ORACLES if n not in WHOLE_CHAIN])
def test_matches_oracle(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) == []


def test_entry_returns_actions(spark):
    result = entry.entry(spark)
    assert {"store", "product", "priority", "action"} <= set(result.columns)
    assert result.count() == 310
