"""Physical plans: what is read, what is shuffled, what is computed how often."""

import re

import pytest
from pyspark.sql import Observation, functions as F

from sluice.operators.rejects import count_columns, validate
from sluice.operators.sequence import add_sequence
from sluice.plans import load as load_module
from sluice.plans.load import abort_on_reject, arrives_in_order, cluster, range_count
from sluice.plans.spec import LoadSpec, TargetColumn as Col
from sluice.queries import LINEITEM_COLUMNS, NATIVE_COLUMNS, NATIVE_SPEC, native_lineitem
from sluice.sources.native import encode_rows
from tests.conftest import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"
SPEC = LoadSpec(
    (Col("id", "INTEGER"), Col("name", "VARCHAR", 25), Col("number", "INTEGER")),
    fields=(("c_custkey", "id"), ("c_mktsegment", "name"), ("c_name", "number")),
)


@pytest.fixture
def plan(capsys):
    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text


def customers(spark):
    return spark.read.parquet(f"{FOLDER}/customer.parquet")


def observed(rows):
    return rows.with_checked(rows.checked.observe(Observation(), *count_columns()))


def test_load_reads_mapped_columns_and_does_not_shuffle(spark, plan):
    text = plan(observed(validate(customers(spark), SPEC, passthrough=False)).loaded)
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in text
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


@pytest.mark.parametrize("abort", [False, True])
def test_conversions_run_once_per_row(spark, plan, abort):
    rows = observed(validate(customers(spark), SPEC, passthrough=False))
    if abort:
        rows = rows.with_checked(abort_on_reject(rows))
    text = plan(rows.loaded)
    assert text.count("RLIKE") == 1
    assert re.search(r"Condition : .*__load_reject", text)


def test_counting_combines_before_it_shuffles(spark, plan):
    text = plan(validate(customers(spark), SPEC, passthrough=False).summary())
    assert text.count("HashAggregate") >= 2 and "partial_count" in text
    assert "c_acctbal" not in text


def test_sequence_shuffles_counts_only(spark, plan):
    text = plan(add_sequence(spark.range(1000), "n"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_files_are_clustered_without_another_sort(spark, plan):
    assert arrives_in_order(customers(spark).where("c_custkey > 5"))
    assert "xxhash64" not in plan(cluster(customers(spark), ["c_mktsegment"], 4))


@pytest.mark.parametrize("shuffled", [
    lambda df: df.repartition(3), lambda df: df.groupBy("c_mktsegment", "c_name").count(), lambda df: df.cache(),
    lambda df: df.sparkSession.createDataFrame(df.limit(5).collect()), lambda df: df.mapInArrow(lambda batches: batches, df.schema),
    lambda df: df.withColumn("r", F.rand()), lambda df: df.withColumn("u", F.udf(lambda x: x)("c_name")),
])
def test_ties_after_a_shuffle_are_numbered_by_content(spark, plan, shuffled):
    """Otherwise a map task that is run again could send rows to other ranges than before."""
    df = shuffled(customers(spark))
    assert not arrives_in_order(df)
    text = plan(cluster(df, ["c_mktsegment"], 4))
    assert 0 < text.index("xxhash64(") < text.index("monotonically_increasing_id()") < text.index("rangepartitioning(c_mktsegment")
    if df.is_cached:
        assert "InMemoryTableScan" in text
        df.unpersist()


def test_native_rows_leave_the_jvm_once(spark, plan):
    rows = validate(native_lineitem(spark, FOLDER), NATIVE_SPEC, passthrough=False)
    text = plan(encode_rows(rows.loaded, NATIVE_COLUMNS))
    assert len(re.findall(r"^\(\d+\) MapInArrow", text, re.M)) == 1
    assert "Exchange" not in text and "BatchEvalPython" not in text
    assert "l_partkey" not in text


def test_all_lineitem_columns_conform_in_one_stage(spark, plan):
    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(validate(df, LoadSpec(LINEITEM_COLUMNS), passthrough=False).loaded)
    assert "Exchange" not in text and "CollectMetrics" in text
    assert "codegen id : 2" in text and "codegen id : 3" not in text  # below and above the count


def test_bad_rows_are_found_before_the_shuffle(spark, plan):
    """A clustered load that aborts does so before its rows are sampled and sorted."""
    rows = validate(customers(spark), LoadSpec((Col("k", "INTEGER"),), fields=(("c_name", "k"),)), passthrough=False)
    text = plan(cluster(abort_on_reject(rows), ["__load_0"], 4).observe("n", F.count(F.lit(1))))
    assert 0 < text.index("raise_error") < text.index("rangepartitioning")


def test_ranges_follow_the_size(spark, monkeypatch):
    df = customers(spark)
    assert range_count(df) == 8
    monkeypatch.setattr(load_module, "RANGE_BYTES", 100)
    assert range_count(df) > 8


def test_more_ranges_than_asked_for(spark, monkeypatch):
    """A number of tasks is the least number of ranges, so that a task's share doesn't grow with the input."""
    df = customers(spark)
    monkeypatch.setattr(load_module, "RANGE_BYTES", 100)
    assert range_count(df, 4) > 4
    assert cluster(df, ["c_name"], 4).rdd.getNumPartitions() == range_count(df, 4)
    monkeypatch.setattr(load_module, "RANGE_BYTES", 32 << 20)
    assert cluster(df, ["c_name"], 4).rdd.getNumPartitions() == 4


def test_profile_of_rejects_is_cut_before_its_shuffle(spark, plan):
    """Each task keeps the first values of a column; values are added up in the tasks, and their shuffle is done once."""
    profile = validate(customers(spark), SPEC, passthrough=False).profile(5)
    assert "WindowGroupLimit" in plan(profile)
    profile.collect()
    final = plan(profile).split("Initial Plan")[0]
    assert "isFinalPlan=true" in plan(profile) and "ReusedExchange" in final
