"""Rows in the partitions that they name."""

import pytest
from pyspark.sql import functions as F

from sluice.errors import LoadPlanError
from sluice.operators.address import addressed
from sluice.plans.load import load
from sluice.plans.spec import LoadSpec, TargetColumn as Col
from sluice.sources.target import PathTarget


def by_partition(rows):
    found = rows.groupBy(F.spark_partition_id().alias("part"), "id").count().collect()
    return sorted((r.part, r.id, r["count"]) for r in found)


def test_each_id_has_its_partition(spark):
    df = spark.range(1000, numPartitions=3).select((F.col("id") % 5).alias("id"))
    found = addressed(df, "id", 6)
    assert by_partition(found.rows) == [(i, i, 200) for i in range(5)] and found.rows.rdd.getNumPartitions() == 6


def test_a_hot_id_is_split_with_its_copies(spark):
    df = spark.range(9000, numPartitions=4).select(F.when(F.col("id") < 8000, 1).otherwise(F.col("id") % 3).alias("id"), F.lit("same").alias("body"))
    for rows in (df, df.repartition(5, "id")):  # in order, and after a shuffle
        found = addressed(rows, "id", 3, most=1000)
        parts = by_partition(found.rows)
        assert found.parts == (1, 9, 1) and found.firsts == (0, 1, 10) and len(parts) == 11
        assert {part: i for part, i, _ in parts} == {0: 0, **dict.fromkeys(range(1, 10), 1), 10: 2}
        assert sum(n for _, _, n in parts) == 9000 and max(n for _, _, n in parts) < 1200
        assert found.rows.schema == rows.schema


@pytest.mark.parametrize("wrong", [None, -1, 3, 1 << 40])
def test_ids_outside_are_refused(spark, wrong):
    df = spark.createDataFrame([(1,), (wrong,)], "id bigint")
    for most in (None, 1):
        with pytest.raises(Exception, match="names no partition"):
            addressed(df, "id", 3, most).rows.collect()


def test_settings_and_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "id int, body string")
    assert addressed(empty, "id", 2, most=5).rows.collect() == []
    for ids, most in ((0, None), (1 << 20, None), (2, 0)):
        with pytest.raises(LoadPlanError):
            addressed(empty, "id", ids, most)
    columns = (Col("id", "INTEGER"), Col("body", "VARCHAR"))
    rows = spark.createDataFrame([(i % 4, str(i)) for i in range(400)], "id int, body string")
    load(addressed(rows, "id", 4, most=50).rows, LoadSpec(columns), PathTarget(str(tmp_path / "out"), columns))
    files = spark.read.parquet(str(tmp_path / "out")).groupBy(F.input_file_name().alias("file")).agg(F.count_distinct("id").alias("ids"))
    assert [r.ids for r in files.collect()] == [1] * 8
