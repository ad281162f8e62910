"""A load's columns against a table as it is."""

import pytest

from sluice.plans.load import check_table, fits
from sluice.plans.spec import LoadSpec, TargetColumn as Col
from sluice.sources.target import create_target

I2, I8 = Col("c", "INTEGER", width=2), Col("c", "BIGINT")


@pytest.mark.parametrize("declared, live, good", [
    (I2, I8, True), (I8, I2, False), (I8, Col("c", "FLOAT"), False), (Col("c", "FLOAT"), Col("c", "DOUBLE PRECISION"), True),
    (Col("c", "NUMERIC", 8, 2), Col("c", "NUMERIC", 9, 3), True), (Col("c", "NUMERIC", 8, 2), Col("c", "NUMERIC", 9, 4), False),
    (Col("c", "NUMERIC", 8, 2), Col("c", "NUMERIC", 8, 1), False), (Col("c", "NUMERIC"), I8, False),
    (Col("c", "VARCHAR", 5), Col("c", "VARCHAR", 6), True), (Col("c", "VARCHAR", 5), Col("c", "VARCHAR", 4), False),
    (Col("c", "VARCHAR"), Col("c", "VARCHAR", 4), False), (Col("c", "VARCHAR", 5), Col("c", "VARCHAR"), True),
    (Col("c", "CHAR", 5), Col("c", "VARCHAR", 5), True), (Col("c", "VARCHAR", 5), Col("c", "CHAR", 5), False),
    (Col("c", "CHAR", 5), Col("c", "CHAR", 6), False), (Col("c", "CHAR", 5), Col("c", "CHAR", 5), True),
    (Col("c", "BINARY", 3), Col("c", "VARBINARY"), True), (Col("c", "BINARY", 3), Col("c", "VARCHAR"), False),
    (Col("c", "TIME"), I8, True), (Col("c", "TIME"), Col("c", "TIMETZ"), False), (Col("c", "INTERVAL"), Col("c", "INTERVAL DAY TO SECOND"), True),
    (Col("c", "DATE"), Col("c", "TIMESTAMP"), False), (Col("c", "BOOLEAN"), Col("c", "BOOLEAN"), True),
])
def test_what_fits(declared, live, good):
    assert fits(declared, live) is good


def test_a_live_table(spark, name):
    create_target(spark, name, (Col("id", "INTEGER", width=4), Col("body", "VARCHAR", 9), Col("more", "DATE")))
    spec = LoadSpec((Col("ID", "INTEGER"), Col("body", "VARCHAR", 9), Col("lost", "FLOAT")))
    assert [(r.level, r.text) for r in check_table(spark, spec, name)] == [
        ("error", "column ID: INTEGER does not fit the table's INTEGER(4 bytes)"), ("error", f"table {name} has no column lost"),
        ("warning", "the table's column more is not loaded")]
    mapped = LoadSpec(spec.columns, (("x", "body"),))
    assert {r.level for r in check_table(spark, mapped, name)} == {"warning"}
    assert [r.level for r in check_table(spark, spec, name + "x")] == ["error"]
