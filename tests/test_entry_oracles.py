"""Driver contract and the DuckDB oracle of every registered query at sf0.01."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tessera.plans.catalog import QUERIES
from tessera.plans.oracles import ORACLES
from tests.compare import compare, duckdb_connection
from tests.conftest import SF_CHECK


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == [
        "season", "teamCode", "games", "wins", "losses", "goalsScored", "goalsConceded", "points"
    ]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    # The training-data queries have tests of their own in tests/llm.
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_CHECK)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    rep = compare(spark, SF_CHECK, name, queries()[name], oracle_sql()[name], con)
    assert rep["ok"], rep
