"""Sequences and the steps around a load."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.errors import LoadAborted, LoadPlanError
from sluice.operators.sequence import add_sequence
from sluice.operators.shape import (
    FieldMeta, abort_after, add_random_fields, add_uuid, generate_rows, replace_formula, replace_where, route, route_merge, set_meta,
)
from sluice.plans.load import load
from sluice.plans.spec import LoadSpec, TargetColumn as Col
from sluice.sources.target import PathTarget, columns_from_schema

FIELDS = {"str": "random string", "uuid": "random uuid", "uuid4": "random uuid4", "integ": "random integer", "numer": "random number"}


def test_sequence_is_dense(spark):
    df = spark.range(0, 5000, 1, 7).where("id % 3 <> 0")
    numbered = add_sequence(df, "n")
    assert sorted(r["n"] for r in numbered.collect()) == list(range(1, df.count() + 1))
    assert numbered.collect() == numbered.collect()


def test_sequence_follows_an_order(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5003).alias("k"))
    numbered = add_sequence(df, "n", start=10, step=-2, order_by=["k"], partitions=5)
    rows = sorted(numbered.collect())
    assert [r["n"] for r in rows] == [10 - 2 * i for i in range(5000)]


def test_sequence_with_a_hot_key_and_copies(spark):
    """A third of all rows are copies of one row; their numbers must not come from one task."""
    df = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 == 0, 50).otherwise(F.col("id") % 100).alias("k"))
    numbered = add_sequence(df, "n", order_by=["k"], partitions=8)
    rows = numbered.groupBy("k").agg(F.min("n"), F.max("n"), F.count_distinct("n")).collect()
    first = 1
    for k, low, high, count in sorted(rows):
        assert (low, high - low + 1) == (first, count)
        first = high + 1
    assert first == 30001
    written = spark.read.parquet(*{f for f in numbered.inputFiles() if "/rows/" in f})
    files = written.where("k = 50").groupBy(F.input_file_name()).count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 6000


def test_sequence_limits(spark):
    assert add_sequence(spark.range(10), "n", maximum=10).count() == 10
    with pytest.raises(LoadPlanError, match="maximum"):
        add_sequence(spark.range(11), "n", maximum=10)
    with pytest.raises(LoadPlanError):
        add_sequence(spark.range(5), "id")
    with pytest.raises(LoadPlanError):
        add_sequence(spark.range(5), "n", step=0)
    assert add_sequence(spark.range(0), "n").count() == 0


def test_random_fields(spark):
    rows = add_random_fields(generate_rows(spark, 1000), "id", FIELDS).collect()
    for r in rows:
        assert re.fullmatch("[0-9a-f]{13}", r["str"])
        assert re.fullmatch("[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", r["uuid"])
        assert re.fullmatch("[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-8[0-9a-f]{3}-[0-9a-f]{12}", r["uuid4"])
        assert -2**31 <= r["integ"] < 2**31 and 0 <= r["numer"] < 1
    for name in FIELDS:
        assert len({r[name] for r in rows}) == 1000
    assert min(r["integ"] for r in rows) < 0 < max(r["integ"] for r in rows)
    assert 0.45 < sum(r["numer"] for r in rows) / 1000 < 0.55
    again = add_random_fields(generate_rows(spark, 1000, partitions=3), "id", FIELDS).collect()
    assert sorted(again) == sorted(rows)
    other = add_random_fields(generate_rows(spark, 1000), "id", FIELDS, seed="1").collect()
    assert not {r["uuid"] for r in other} & {r["uuid"] for r in rows}
    with pytest.raises(LoadPlanError):
        add_random_fields(spark.range(1), "id", {"x": "random colour"})
    assert add_uuid(spark.range(100), "u").select("u").distinct().count() == 100


def test_route(spark):
    df = spark.createDataFrame([(7, "a"), (8, "b"), (None, "c")], "valuename int, str string")
    met, rest = route(df, F.col("valuename") == 7)
    assert met.collect() == [(7, "a")] and rest.collect() == [(8, "b"), (None, "c")]
    marked = [(7, "\\."), (8, "b"), (None, "c")]
    merged = route_merge(df, F.col("valuename") == 7, lambda d: replace_formula(d, "str", r"r'\.'"))
    assert sorted(merged.collect(), key=str) == sorted(marked, key=str)
    assert replace_where(df, F.col("valuename") == 7, {"STR": r"r'\.'"}).collect() == marked


def test_formula_keeps_the_type(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert replace_formula(df, "n", "n + 1L").dtypes == df.dtypes
    with pytest.raises(LoadPlanError):
        replace_formula(df, "x", "1")


def test_meta(spark):
    df = spark.createDataFrame([("abc", 5, 0.123456)], "s string, i long, n double")
    described = set_meta(df, [FieldMeta("s", length=13), FieldMeta("i", "integ", 10, 0), FieldMeta("n", length=10, precision=5)])
    assert described.collect() == [("abc", 5, Decimal("0.12346"))]
    assert [c.type_text for c in columns_from_schema(described.schema)] == ["VARCHAR(13)", "INTEGER", "NUMERIC(10,5)"]
    assert set_meta(df, [FieldMeta("i", "j")], select_unspecified=True).columns == ["j", "s", "n"]
    with pytest.raises(Exception, match="does not fit"):
        set_meta(spark.createDataFrame([(1e9,)], "n double"), [FieldMeta("n", length=10, precision=5)]).collect()


def test_abort_after(spark):
    assert abort_after(spark.range(100), 100).count() == 100
    with pytest.raises(LoadAborted, match="limit of 100"):
        abort_after(spark.range(101), 100)


def test_sample_with_extra_field(spark, tmp_path):
    """A numbered stream has one field more than the table: refused by position, left out by name."""
    described = set_meta(add_random_fields(add_sequence(generate_rows(spark, 10), "valuename"), "id", FIELDS).drop("id"), [
        FieldMeta("valuename"), FieldMeta("str", length=13), FieldMeta("uuid", length=36), FieldMeta("uuid4", length=36),
        FieldMeta("integ", length=10, precision=0), FieldMeta("numer", length=10, precision=5)])
    columns = columns_from_schema(described.drop("valuename").schema)
    with pytest.raises(LoadPlanError, match="too many fields"):
        load(described, LoadSpec(columns), PathTarget(str(tmp_path / "a"), columns))
    spec = LoadSpec(columns, fields=[(c.name, c.name) for c in columns])
    assert load(described, spec, PathTarget(str(tmp_path / "a"), columns)).rows_accepted == 10
    assert spark.read.parquet(str(tmp_path / "a")).columns == list(FIELDS)


def test_sample_with_end_marker(spark, tmp_path):
    rows = add_random_fields(add_sequence(generate_rows(spark, 1000), "valuename"), "id", FIELDS).drop("id")
    marked = replace_where(rows, F.col("valuename") == 7, {"str": r"r'\.'"}).select("valuename", "str")
    columns = (Col("valuename", "INTEGER"), Col("str", "VARCHAR", 13))
    assert load(marked, LoadSpec(columns), PathTarget(str(tmp_path / "a"), columns)).rows_accepted == 1000
    loaded = spark.read.parquet(str(tmp_path / "a"))
    assert loaded.count() == 1000 and loaded.where("valuename = 7").first()["str"] == "\\."
