"""Bringing an existing table to the columns of a load."""

import pytest

from sluice.errors import LoadPlanError
from sluice.plans.evolve import evolution, evolve_target
from sluice.plans.load import load
from sluice.plans.spec import LoadSpec, TargetColumn as Col
from sluice.sources.target import PathTarget, TableTarget, columns_from_table, create_target

FIRST = (Col("id", "INTEGER"), Col("body", "VARCHAR", 3), Col("odd `name'\\", "INTEGER", width=4))


def kinds(steps):
    return [step.kind for step in steps]


def test_a_table_gets_new_columns(spark, name):
    create_target(spark, name, FIRST)
    load(spark.createDataFrame([(1, "abc")], "id int, body string"), LoadSpec(FIRST[:2]), TableTarget(name))
    wanted = (Col("BODY", "VARCHAR", 3), Col("at", "TIME"), Col("raw", "BINARY", 3, fixed=True), Col("n", "NUMERIC", 9, 2), Col("it's", "VARCHAR", 4))
    assert kinds(evolution(spark, name, wanted)) == ["keep", "add", "add", "add", "add"]
    evolve_target(spark, name, wanted)
    assert kinds(evolve_target(spark, name, wanted)) == ["keep"] * 5
    live = columns_from_table(spark, name)
    assert live == (*FIRST, *wanted[1:])
    load(spark.createDataFrame([("abd", "x")], "body string, i string"), LoadSpec((live[1], live[-1])), TableTarget(name))
    assert sorted((r.id, r.body, r.n, r["it's"]) for r in spark.table(name).collect() if r.id) == [(1, "abc", None, None)]
    assert [(r.body, r["it's"]) for r in spark.table(name).where("id IS NULL").collect()] == [("abd", "x")]


@pytest.mark.parametrize("wrong", [
    Col("id", "VARCHAR", 9), Col("id", "FLOAT"), Col("body", "INTEGER"),
    Col("body", "VARCHAR", 4), Col("body", "VARCHAR"), Col("body", "CHAR", 4), Col("odd `name'\\", "INTEGER")])
def test_other_changes_are_refused_before_any(spark, name, wrong):
    create_target(spark, name, FIRST)
    before = spark.table(name).schema
    with pytest.raises(LoadPlanError, match="cannot become"):
        evolve_target(spark, name, (Col("more", "DATE"), wrong))
    assert spark.table(name).schema == before


def test_narrower_columns_leave_the_table_as_it_is(spark, name):
    create_target(spark, name, FIRST)
    assert kinds(evolve_target(spark, name, (Col("id", "INTEGER", width=2), Col("body", "VARCHAR", 1)))) == ["keep", "keep"]
    assert columns_from_table(spark, name) == FIRST


def test_loads_evolve_their_target(spark, name, tmp_path):
    rows = spark.createDataFrame([(1, "abcd", "2020-01-01")], "id int, body string, d string")
    columns = (Col("id", "INTEGER"), Col("body", "VARCHAR", 4))
    load(rows.drop("d"), LoadSpec(columns), TableTarget(name), evolve=True)  # there is no table yet
    with pytest.raises(LoadPlanError, match="does not fit|no column"):
        load(rows, LoadSpec((*columns, Col("d", "VARCHAR", 10))), TableTarget(name))
    load(rows, LoadSpec((*columns, Col("d", "VARCHAR", 10))), TableTarget(name), evolve=True)
    assert sorted((r.id, r.d or "") for r in spark.table(name).collect()) == [(1, ""), (1, "2020-01-01")]
    with pytest.raises(LoadPlanError, match="catalog tables"):
        load(rows.drop("d"), LoadSpec(columns), PathTarget(str(tmp_path / "x"), columns), evolve=True)
