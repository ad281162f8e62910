"""Every query against its SQL on the sf0.01 tables."""

import os

import pytest

from sluice.queries import ORACLES, QUERIES
from tests.conftest import TESTDATA
from tests.oracle import connect, differences

FOLDER = os.path.join(TESTDATA, "sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("query", sorted(QUERIES))
def test_query_matches_sql(spark, duck, query):
    assert query in ORACLES
    assert differences(QUERIES[query](spark, FOLDER), duck, ORACLES[query]) == []
