"""Mapping, control tables and checks that run no job."""

import pytest
from pyspark.sql import types as T

from sluice.errors import LoadPlanError
from sluice.operators.mapping import map_by_name, map_by_position, resolve_mapping
from sluice.plans.load import check_load
from sluice.plans.spec import LoadSpec, TargetColumn as Col
from sluice.sources.control import CONTROL_SCHEMA, spec_from_control_table, target_for
from sluice.sources.target import JdbcTarget, TableTarget, columns_from_schema, columns_from_table, create_target

ABC = (Col("a", "INTEGER"), Col("b", "VARCHAR", 5), Col("c", "DATE"))


@pytest.fixture(scope="module")
def stream(spark):
    return spark.createDataFrame([(1, "x", "y")], "one long, two string, `th.ree` string")


def test_by_position(spark, stream):
    assert map_by_position(stream.select("one", "two"), ABC).columns == ["a", "b"]
    with pytest.raises(LoadPlanError, match="too many fields"):
        map_by_position(stream.withColumn("four", stream.one), ABC)


def test_by_name(stream):
    mapped = map_by_name(stream, ABC, [("th.ree", "b"), ("ONE", "A")])
    assert mapped.columns == ["b", "a"]
    assert mapped.first() == ("y", 1)


@pytest.mark.parametrize("pairs, message", [
    ([("zero", "a")], r"fed by field \[zero\]"),
    ([(None, "a")], r"fed by field \[None\]"),
    ([("one", "z")], r"column \[z\] is not in the target"),
    ([("one", "a"), ("two", "a")], "mapped twice"),
])
def test_bad_pairs(stream, pairs, message):
    with pytest.raises(LoadPlanError, match=message):
        map_by_name(stream, ABC, pairs)


def test_names_differing_in_case():
    schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("X", T.LongType())])
    spec = LoadSpec(ABC, fields=[("X", "a")])
    assert resolve_mapping(schema, spec)[0].source.name == "X"
    schema = T.StructType([T.StructField("xy", T.LongType()), T.StructField("XY", T.LongType())])
    with pytest.raises(LoadPlanError, match="ambiguous"):
        resolve_mapping(schema, LoadSpec(ABC, fields=[("Xy", "a")]))


def test_check_names_both_ways(stream):
    remarks = check_load(stream.schema, LoadSpec(ABC, fields=[("one", "a"), ("two", "b")]))
    assert [(r.level, r.text) for r in remarks] == [
        ("warning", "field th.ree is not loaded"), ("warning", "column c gets no value from the stream"),
    ]
    remarks = check_load(stream.schema, LoadSpec(ABC, fields=[("two", "c"), ("th.ree", "a")]))
    assert [r.level for r in remarks] == ["error", "warning", "warning"]
    assert check_load(stream.schema, LoadSpec(ABC, fields=[]))[0].level == "error"


def control(spark, entries):
    return spark.createDataFrame([("l",) + e for e in entries] + [("other", "STREAMNAME", None, "x")], CONTROL_SCHEMA)


def test_control_table_holds_every_setting(spark):
    spec = spec_from_control_table(control(spark, [
        ("SCHEMANAME", None, "s"), ("TABLENAME", None, "t"), ("DIRECT", None, "Y"), ("abortonerror", None, "N"),
        ("EXCEPTIONSFILENAME", None, "/e"), ("REJECTEDDATAFILENAME", None, "  "), ("STREAMNAME", None, "n"),
        ("CONNECTIONNAME", None, "c"), ("FIELDSTREAM", 2, "s6"), ("FIELDSTREAM", 0, "s4"), ("FIELDSTREAM", 1, "s5"),
        ("FIELDDATABASE", 0, "a"), ("FIELDDATABASE", 1, "b"), ("FIELDDATABASE", 2, "c"),
    ]), "l", ABC)
    assert spec.table == "s.t" and spec.stream_name == "n" and spec.connection == "c"
    assert spec.abort_on_error is False
    assert spec.exceptions_path == "/e" and spec.rejected_path is None
    assert spec.fields == (("s4", "a"), ("s5", "b"), ("s6", "c"))


def test_control_table_defaults_and_uneven_lists(spark, stream):
    columns = tuple(Col(f"d{i}", "INTEGER") for i in range(5))
    entries = [("FIELDDATABASE", i, c.name) for i, c in enumerate(columns)]
    entries += [("FIELDSTREAM", i, "one") for i in range(3)]
    spec = spec_from_control_table(control(spark, entries), "l", columns)
    assert spec.abort_on_error is True
    assert [s for s, _ in spec.fields] == ["one", "one", "one", None, None]
    with pytest.raises(LoadPlanError, match="does not have"):
        resolve_mapping(stream.schema, spec)
    assert spec_from_control_table(control(spark, [("DIRECT", None, "N")]), "l", columns).fields is None


@pytest.mark.parametrize("streams, targets, message", [
    ([(0, "s0"), (2, "s2")], [(0, "a"), (1, "b"), (2, "c")], "columns without a stream field: b"),
    ([(0, "s0"), (1, "s1"), (2, "s2")], [(0, "a"), (2, "c")], "stream fields without a column: s1"),
    ([(0, "s0"), (1, "s1")], [(0, "a")], "stream fields without a column: s1"),
    ([(0, "s0"), (0, "s1")], [(0, "a"), (1, "b")], "FIELDSTREAM has position 0 twice"),
    ([(0, "s0"), (1, "s1")], [(1, "a"), (1, "b")], "FIELDDATABASE has position 1 twice"),
    ([(None, "s0")], [(0, "a")], "FIELDSTREAM entry s0 has no position"),
    ([(i, f"s{i}") for i in range(9)], [(i, f"t{i}") for i in range(9)], "more fields than the target has columns"),
])
def test_lists_pair_by_position(spark, streams, targets, message):
    entries = [("FIELDSTREAM", *e) for e in streams] + [("FIELDDATABASE", *e) for e in targets]
    with pytest.raises(LoadPlanError, match=message):
        spec_from_control_table(control(spark, entries), "l", ABC)


def test_positions_may_have_gaps(spark):
    entries = [("FIELDDATABASE", 40, "c"), ("FIELDSTREAM", -3, "x"), ("FIELDDATABASE", -3, "b"), ("FIELDSTREAM", 40, "y")]
    assert spec_from_control_table(control(spark, entries), "l", ABC).fields == (("x", "b"), ("y", "c"))


@pytest.mark.parametrize("entries, message", [
    ([("COLOUR", None, "red")], "unknown control keys: COLOUR"),
    ([("TABLENAME", None, "a"), ("TABLENAME", None, "b")], "twice"),
    ([("TABLENAME", None, "no_such_table")], "does not exist"),
    ([("STREAMNAME", None, "n")], "no target table"),
])
def test_bad_control_tables(spark, entries, message):
    with pytest.raises(LoadPlanError, match=message):
        spec_from_control_table(control(spark, entries), "l")
    with pytest.raises(LoadPlanError, match="no load"):
        spec_from_control_table(control(spark, entries), "missing")


def test_columns_of_a_table(spark, name):
    spark.sql(f"""CREATE TABLE {name} (a CHAR(3), b VARCHAR(5), c STRING, d INT, e SMALLINT, f DECIMAL(7,2), g DATE,
        h TIMESTAMP, i TIMESTAMP_NTZ, j BINARY, k FLOAT, l BOOLEAN, m INTERVAL DAY TO SECOND) USING parquet""")
    assert [c.type_text for c in columns_from_table(spark, name)] == [
        "CHAR(3)", "VARCHAR(5)", "VARCHAR", "INTEGER(4 bytes)", "INTEGER(2 bytes)", "NUMERIC(7,2)", "DATE", "TIMESTAMPTZ",
        "TIMESTAMP", "VARBINARY", "FLOAT", "BOOLEAN", "INTERVAL",
    ]


def test_created_table_has_the_declared_types(spark, name):
    columns = (Col("a", "CHAR", 3), Col("b", "VARCHAR", 5), Col("c", "NUMERIC", 7, 2), Col("d", "INTEGER", width=2),
               Col("e", "TIMESTAMP"), Col("f", "VARCHAR"), Col("g", "VARBINARY"))
    create_target(spark, name, columns)
    create_target(spark, name, columns)  # leaves an existing table alone
    assert columns_from_table(spark, name) == columns


def test_nested_types_have_no_target_column(spark):
    with pytest.raises(LoadPlanError, match="not supported"):
        columns_from_schema(T.StructType([T.StructField("e", T.ArrayType(T.FloatType()))]))


def test_targets_by_connection_name():
    connections = {"c": {"url": "jdbc:x:y", "user": "u"}}
    assert target_for(LoadSpec(ABC, table="t")) == TableTarget("t")
    assert target_for(LoadSpec(ABC, table="t", connection="c"), connections) == JdbcTarget("jdbc:x:y", "t", {"user": "u"})
    assert connections == {"c": {"url": "jdbc:x:y", "user": "u"}}
    for spec in (LoadSpec(ABC), LoadSpec(ABC, table="t", connection="d")):
        with pytest.raises(LoadPlanError):
            target_for(spec, connections)
