"""Rows and reject logs written by one job."""

import json
import os
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from sluice.errors import LoadAborted, LoadPlanError
from sluice.plans.load import LoadReport, load
from sluice.plans.spec import LoadSpec, TargetColumn as Col
from sluice.sources import routed
from sluice.sources.target import PathTarget, TableTarget

COLUMNS = (Col("id", "INTEGER"), Col("code", "VARCHAR", 3), Col("extra", "NUMERIC", 8, 2))


@pytest.fixture
def place(tmp_path):
    return lambda name: str(tmp_path / name)


def spec_of(place, **options):
    return LoadSpec(COLUMNS[:2], abort_on_error=False, rejected_path=place("r"), exceptions_path=place("e")).with_options(**options)


def numbers(spark, n=1000, bad=7, parts=4):
    """Every ``bad``-th code is too long."""
    return spark.range(0, n, 1, parts).select("id", F.when(F.col("id") % bad == 0, F.lit("long")).otherwise("ok").alias("code"))


def visible(path):
    return sorted(f for f in os.listdir(path) if f[0] not in "._") if os.path.exists(path) else []


def jobs_of(spark, run):
    group = "jobs-" + os.urandom(4).hex()
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_one_job_writes_everything(spark, place):
    source = place("source")
    numbers(spark).write.parquet(source)
    df = spark.read.schema("id long, code string").parquet(source)
    reports = []
    assert jobs_of(spark, lambda: reports.append(load(df, spec_of(place), PathTarget(place("t"), COLUMNS)))) == 1
    assert reports == [LoadReport(1000, 857, 143)]
    assert reports[0].reasons == {"code: longer than 3 bytes": 143}
    loaded = spark.read.parquet(place("t"))
    assert loaded.dtypes == [("id", "bigint"), ("code", "string"), ("extra", "decimal(8,2)")]
    assert sorted(r.id for r in loaded.collect()) == [i for i in range(1000) if i % 7]
    rejected = spark.read.parquet(place("r"))
    assert rejected.columns == ["id", "code", "rejected_line", "reject_reason", "rejected_at"]
    assert sorted((r.id, r.rejected_line) for r in rejected.collect()) == [(i, f"{i} | long") for i in range(0, 1000, 7)]
    logged = spark.read.parquet(place("e")).select("column", "target_type", "value", "reason").distinct().collect()
    assert logged == [("code", "VARCHAR(3)", "long", "code: longer than 3 bytes")]


@pytest.mark.parametrize("log_format", ["parquet", "json", "text"])
def test_logs_are_those_of_two_passes(spark, place, log_format):
    """Catalog tables still take the logs from a pass of their own; both give the same entries."""
    spec, df = spec_of(place, log_format=log_format), numbers(spark)
    load(df, spec, PathTarget(place("t"), COLUMNS))
    two = spec.with_options(rejected_path=place("r2"), exceptions_path=place("e2"))
    load(df, two, PathTarget(place("t2"), COLUMNS, "orc"))
    for a, b in (("r", "r2"), ("e", "e2")):
        one, other = (spark.read.format(log_format).load(place(p)) for p in (a, b))
        assert one.schema == other.schema
        if log_format == "text":
            one, other = (x.select(F.regexp_replace("value", "^.*? - ", "").alias("value")) for x in (one, other))
        one, other = (x.drop("rejected_at") for x in (one, other))
        assert one.count() == 143 and one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_every_type_comes_back(spark, place):
    schema = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("b", T.ByteType()), T.StructField("s", T.ShortType()), T.StructField("f", T.FloatType()),
        T.StructField("d", T.DecimalType(30, 4)), T.StructField("day", T.DateType()), T.StructField("t", T.TimestampType()),
        T.StructField("n", T.TimestampNTZType()), T.StructField("iv", T.DayTimeIntervalType()), T.StructField("raw", T.BinaryType()),
        T.StructField("a", T.ArrayType(T.StructType([T.StructField("x", T.IntegerType())]))), T.StructField("m", T.MapType(T.StringType(), T.LongType())),
        T.StructField("yes", T.BooleanType())])
    moment = datetime(1850, 3, 4, 5, 6, 7, 123456)
    row = ("x", 1, 2, 0.5, Decimal("-1.2345"), date(1, 1, 1), moment, moment, timedelta(days=-3, microseconds=5), b"\x00\xff", [(1,), (None,)], {"k": 1}, True)
    df = spark.createDataFrame([row, ("1", *row[1:]), ("y", *(None,) * (len(row) - 1))], schema)
    columns = (Col("id", "INTEGER"),)
    spec = LoadSpec(columns, (("id", "id"),), abort_on_error=False, rejected_path=place("r"))
    assert load(df, spec, PathTarget(place("t"), columns)) == LoadReport(3, 1, 2)
    back = spark.read.parquet(place("r")).drop("rejected_line", "reject_reason", "rejected_at")
    assert back.schema == schema
    assert sorted(back.collect(), key=str) == sorted(df.where("id != '1'").collect(), key=str)


def test_columns_that_tasks_cannot_write_take_two_passes(spark, place):
    df = spark.range(3).select(F.col("id").cast("string"), F.expr("array(interval '1' day)").alias("steps"), F.lit("x").alias("code"))
    columns = (Col("code", "INTEGER"),)
    spec = LoadSpec(columns, (("code", "code"),), abort_on_error=False, rejected_path=place("r"))
    assert load(df, spec, PathTarget(place("t"), columns)) == LoadReport(3, 0, 3)
    assert spark.read.parquet(place("r")).count() == 3 and not os.path.exists(place("t") + "/_loads")


def test_first_row_alone_is_logged_on_abort(spark, place):
    spec = spec_of(place, abort_on_error=True, abort_log="first")
    load(numbers(spark, bad=5000).where("id > 0"), spec, PathTarget(place("t"), COLUMNS))
    before = visible(place("t"))
    with pytest.raises(LoadAborted) as caught:
        load(numbers(spark), spec, PathTarget(place("t"), COLUMNS))
    assert caught.value.reason == "code: longer than 3 bytes"
    assert visible(place("t")) == before and spark.read.parquet(place("t")).count() == 999
    (row,) = spark.read.parquet(place("r")).collect()
    (entry,) = spark.read.parquet(place("e")).collect()
    assert row.id % 7 == 0 and entry["value"] == "long" and entry.column == "code"
    with pytest.raises(LoadPlanError, match="abort_log"):
        spec.with_options(abort_log="some")


def test_overwriting_and_appending(spark, place):
    for mode, log_mode, rows, entries in (("append", "append", 857, 143), ("append", "append", 1714, 286), ("overwrite", "overwrite", 857, 143)):
        load(numbers(spark), spec_of(place), PathTarget(place("t"), COLUMNS, mode=mode), log_mode=log_mode)
        assert spark.read.parquet(place("t")).count() == rows
        assert spark.read.parquet(place("r")).count() == spark.read.parquet(place("e")).count() == entries
    load(numbers(spark, bad=5000).where("id > 0"), spec_of(place), PathTarget(place("t"), COLUMNS, mode="overwrite"), log_mode="overwrite")
    assert spark.read.parquet(place("t")).count() == 999 and visible(place("r")) == []


def test_a_load_id_is_loaded_once(spark, place):
    target = PathTarget(place("t"), COLUMNS)
    spec = LoadSpec(COLUMNS[:2], abort_on_error=False)
    for _ in range(2):
        report = load(numbers(spark), spec, target, load_id="day-1")
        assert report == LoadReport(1000, 857, 143) and report.reasons == {"code: longer than 3 bytes": 143}
    assert jobs_of(spark, lambda: load(numbers(spark), spec, target, load_id="day-1")) == 0
    load(numbers(spark), spec, target, load_id="day-2")
    assert spark.read.parquet(place("t")).count() == 2 * 857
    for wrong, where in (("a/b", target), ("", target), ("x", TableTarget("t")), ("x", PathTarget(place("u"), COLUMNS, "orc"))):
        with pytest.raises(LoadPlanError, match="load id"):
            load(numbers(spark), spec, where, load_id=wrong)


def test_a_published_run_is_completed_later(spark, place):
    """The driver is lost after the manifest, with some files moved; and before it, with none published."""
    target, spec = PathTarget(place("t"), COLUMNS), spec_of(place)
    load(numbers(spark), spec, target, load_id="a")
    manifest = routed.ledger_entry(place("t"), "a")
    for output, name in manifest["moves"][1:]:
        folder = manifest["roots"][output].removeprefix("file:")
        os.makedirs(f"{folder}/_staging/a", exist_ok=True)
        os.rename(f"{folder}/{name}", f"{folder}/_staging/a/{name}")
    os.makedirs(place("t") + "/_staging/lost")
    assert spark.read.parquet(place("t")).count() < 857
    assert routed.finish(place("t")) == ["a"]
    assert spark.read.parquet(place("t")).count() == 857 and spark.read.parquet(place("r")).count() == 143
    assert routed.finish(place("t")) == [] and os.listdir(place("t") + "/_staging") == ["lost"]


def test_attempts_that_did_not_count_are_not_published(spark, place):
    """A task whose first attempt fails after it wrote leaves nothing that readers see."""
    writer = routed.RoutedWriter({"run": "r", "roots": {"accepted": place("t")}, "overwrite": [], "log_format": "parquet", "abort": False,
                                  "version": spark.version, "schemas": {"accepted": T.StructType([T.StructField("id", T.LongType())]).json()}})
    for name in ("part-0-r-1", "part-0-r-2"):
        file = writer._file("accepted", name)
        file.add(routed.pa.array([{"id": 1}], routed.pa.struct([("id", routed.pa.int64())])))
        file.close()
    writer.commit([routed.TaskWritten({"accepted": "part-0-r-2"}, {"accepted": 1}), None])
    assert visible(place("t")) == ["part-0-r-2.snappy.parquet"] and spark.read.parquet(place("t")).collect() == [(1,)]
    with open(place("t") + "/_loads/r.json") as file:
        assert json.load(file)["rows_accepted"] == 1


def test_clustered_rows_and_wide_logs(spark, place):
    df = numbers(spark).withColumn("more", F.struct(F.lit(1).alias("x")))
    report = load(df.repartition(4), spec_of(place, fields=(("id", "id"), ("code", "code"))), PathTarget(place("t"), COLUMNS), parallelism=3, cluster_by=["id"])
    assert report == LoadReport(1000, 857, 143)
    ids = [r.id for r in spark.read.parquet(place("t")).collect()]
    assert sorted(ids) == [i for i in range(1000) if i % 7]
    assert spark.read.parquet(place("r")).where("more.x = 1").count() == 143


@pytest.mark.parametrize("logged", [True, False])
def test_a_limit_of_rejects(spark, place, logged):
    source = numbers(spark, n=1400)  # 200 bad rows, 50 in each task
    target = PathTarget(place("t"), COLUMNS)
    options = {} if logged else {"rejected_path": None, "exceptions_path": None}
    for most in (0, 20, 199):  # passed within a task, and only by all of them
        with pytest.raises(LoadAborted, match=f"more than {most} rejects, most often: code: longer than 3 bytes"):
            load(source, spec_of(place, most_rejects=most, **options), target)
        assert [visible(place(p)) for p in "tre"] == [[], [], []]
        assert not any(os.listdir(f"{place(p)}/{routed.STAGING}") for p in "tre" if os.path.exists(f"{place(p)}/{routed.STAGING}"))
    reports = []
    assert jobs_of(spark, lambda: reports.append(load(source, spec_of(place, most_rejects=200, **options), target))) == 1
    assert reports == [LoadReport(1400, 1200, 200)] and spark.read.parquet(place("t")).count() == 1200
    assert not logged or spark.read.parquet(place("r")).count() == 200


def test_limits_that_cannot_be_kept(spark, place):
    with pytest.raises(LoadPlanError, match="limit of rejects"):
        load(numbers(spark), spec_of(place, most_rejects=1), PathTarget(place("t"), COLUMNS, format="json"))
    with pytest.raises(LoadPlanError, match="most_rejects"):
        spec_of(place, most_rejects=-1)
