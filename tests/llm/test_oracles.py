"""Queries that SQL can express, against DuckDB; and every query's columns and rows."""

import pytest

import corpus_pipeline
from sluice.llm.queries import ORACLES, QUERIES
from tests.conftest import TESTDATA
from tests.oracle import connect, differences

FOLDER = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("query", sorted(ORACLES))
def test_query_matches_sql(spark, duck, query):
    assert differences(QUERIES[query](spark, FOLDER), duck, ORACLES[query]) == []


def test_queries_are_registered():
    from __spark_entry__ import oracle_sql, queries

    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in queries()}
    assert queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()
