"""Every registered query against its SQL twin, value by value."""

import pytest
from compare import differences, duck
from oracle import oracle_sql

from ledgerloom.plans.registry import registered

QUERIES, STATEMENTS = registered(), oracle_sql()


@pytest.fixture(scope="module")
def database(small_folder):
    connection = duck(small_folder)
    yield connection
    connection.close()


def test_each_query_has_a_twin():
    assert QUERIES.keys() == STATEMENTS.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, small_folder, database, name):
    result = QUERIES[name](spark, small_folder)
    assert differences(result, database, STATEMENTS[name]) == []
