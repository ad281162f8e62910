"""Tables in the shared folder: what their writes leave on local disks."""

import time

import pytest

from sluice.sources import workspace


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {path for path in found.split("\n") if "/shuffle_" in path}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """Writes that follow each other don't add up on the executors' disks."""
    before = shuffle_files(spark)
    df = spark.range(20_000).selectExpr("id % 977 AS k", "id")
    for i in range(3):
        df = workspace.write_table(df.repartition(5, "k", "id").groupBy("k").agg({"id": "sum"}).toDF("k", "id"), f"file://{tmp_path}/{i}")
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert df.count() == 977 and df.agg({"id": "sum"}).first()[0] == sum(range(20_000))


@pytest.mark.parametrize("setting", [None, "false", "true"])
def test_the_setting_is_put_back(spark, tmp_path, setting):
    key = workspace.CLEANUP
    default = spark.conf.get(key, None)
    if setting is not None:
        spark.conf.set(key, setting)
    try:
        held = spark.conf.get(key, None)
        with workspace.shuffles_removed(spark):
            workspace.write_table(spark.range(3), f"file://{tmp_path}/t")
            assert spark.conf.get(key) == "true"  # the outer block goes on
        with pytest.raises(Exception):
            workspace.write_table(spark.range(3).selectExpr("raise_error('no')"), f"file://{tmp_path}/u")
        assert spark.conf.get(key, None) == held and not workspace._writes
    finally:
        spark.conf.unset(key)
    assert spark.conf.get(key, None) == default
