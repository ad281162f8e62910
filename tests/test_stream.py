"""Stream loads: batches, retries, restarts and aborting."""

import pytest
from pyspark.sql import functions as F

from sluice.errors import LoadPlanError
from sluice.plans.spec import LoadSpec, TargetColumn as Col
from sluice.sources.native import published_rows, read_manifests
from sluice.streaming.stream import NativeStreamTarget, StreamTarget, TableStreamTarget, stream_load

COLUMNS = (Col("id", "INTEGER"), Col("body", "VARCHAR", 6))
NOW = {"availableNow": True}


class Setup:
    def __init__(self, spark, tmp_path):
        self.spark, self.source = spark, str(tmp_path / "in")
        self.target = StreamTarget(str(tmp_path / "out"), COLUMNS)
        self.log, self.checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
        self.reports = {}

    def add(self, start, end):
        rows = self.spark.range(start, end).select("id", F.concat(F.lit("row"), F.col("id").cast("string")).alias("text"))
        rows.coalesce(1).write.mode("append").parquet(self.source)

    def run(self, **options):
        stream = self.spark.readStream.schema("id long, text string").option("maxFilesPerTrigger", 1).parquet(self.source)
        spec = LoadSpec(COLUMNS, **{"abort_on_error": False, "rejected_path": self.log, **options})
        query = stream_load(stream, spec, self.target, self.checkpoint, NOW, self.reports.__setitem__)
        query.awaitTermination()
        return query

    def loaded(self):
        return sorted(r["id"] for r in self.spark.read.parquet(self.target.path).collect())


@pytest.fixture
def setup(spark, tmp_path):
    return Setup(spark, tmp_path)


def test_batches_and_restart(spark, setup):
    setup.add(990, 1010)  # from 1000 on the text has seven bytes
    setup.add(0, 10)
    setup.run()
    assert setup.loaded() == list(range(10)) + list(range(990, 1000))
    setup.add(10, 20)
    setup.run()
    assert setup.loaded() == list(range(20)) + list(range(990, 1000))
    assert sum(r.rows_read for r in setup.reports.values()) == 40
    assert sum(r.rows_rejected for r in setup.reports.values()) == 10
    rejected = spark.read.parquet(setup.log)
    assert sorted(r["id"] for r in rejected.collect()) == list(range(1000, 1010))


def test_repeated_batch_replaces_itself(spark, setup):
    """A batch that was written but not recorded is run again after a restart."""
    setup.add(0, 10)
    setup.add(995, 1005)
    failing = iter([True])

    def fail_once(batch_id, report):
        if batch_id == 1 and next(failing, False):
            raise OSError("lost the driver")

    setup.reports = type("Hook", (), {"__setitem__": lambda self, b, r: fail_once(b, r)})()
    with pytest.raises(Exception, match="lost the driver"):
        setup.run()
    setup.run()
    assert setup.loaded() == list(range(10)) + list(range(995, 1000))
    assert spark.read.parquet(setup.log).count() == 5


def test_abort_stops_the_query(spark, setup):
    setup.add(0, 10)
    setup.add(1000, 1001)
    with pytest.raises(Exception, match="nothing was loaded"):
        setup.run(abort_on_error=True)
    assert setup.loaded() == list(range(10))
    assert spark.read.parquet(setup.log).count() == 1


def test_stream_is_named_and_checked(spark, setup):
    setup.add(0, 1)
    assert setup.run(stream_name="nightly").name == "nightly"
    with pytest.raises(LoadPlanError):
        setup.run(fields=[("nope", "id")])


@pytest.mark.parametrize("kind", ["table", "native"])
def test_other_targets_take_a_batch_once(spark, setup, name, tmp_path, kind):
    """A batch that was written but not recorded is run again; the table or folder has it once."""
    out = str(tmp_path / "native")
    setup.target = TableStreamTarget(name, COLUMNS) if kind == "table" else NativeStreamTarget(out, COLUMNS)
    setup.add(0, 10)
    setup.add(995, 1005)
    failing = iter([True])

    def report(batch, counts):
        setup.reports[batch] = counts
        if next(failing, False):
            raise OSError("driver lost")

    stream = spark.readStream.schema("id long, text string").option("maxFilesPerTrigger", 1).parquet(setup.source)
    spec = LoadSpec(COLUMNS, abort_on_error=False)
    with pytest.raises(Exception):
        stream_load(stream, spec, setup.target, setup.checkpoint, NOW, report).awaitTermination()
    stream_load(stream, spec, setup.target, setup.checkpoint, NOW, report).awaitTermination()
    if kind == "table":
        assert sorted(r.id for r in spark.table(name).collect()) == list(range(10)) + list(range(995, 1000))
        assert spark.table(name).columns == ["id", "body", "batch_id"]
    else:
        assert published_rows(spark, out, 2).count() == 15
        assert sorted(m["run"] for m in read_manifests(out)) == ["batch0", "batch1"]
