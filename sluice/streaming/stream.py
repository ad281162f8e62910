"""Loading a stream: every micro-batch is one load, published once however often it is retried."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.errors import LoadPlanError
from sluice.operators.rejects import validate
from sluice.plans.load import abort_on_reject, check_load, load
from sluice.plans.spec import LoadSpec
from sluice.sources.native import FORMAT, NativeSink, NativeTarget, sink_options, wire_columns
from sluice.sources.target import PathTarget, full_row

BATCH = "batch_id"


@dataclass(frozen=True)
class StreamTarget:
    """A folder with one ``batch_id=N`` partition per micro-batch; a repeated batch replaces its own."""

    path: str
    columns: tuple
    format: str = "parquet"

    def batch(self, batch_id: int) -> PathTarget:
        return PathTarget(_partition(self.path, batch_id), self.columns, self.format, mode="overwrite")


@dataclass(frozen=True)
class NativeStreamTarget:
    """Native files; a batch is a run of its own, and a repeated batch publishes its run again in place of the first try."""

    path: str
    columns: tuple

    def batch(self, batch_id: int) -> NativeTarget:
        return NativeTarget(self.path, self.columns, run=f"batch{batch_id}")


@dataclass(frozen=True)
class TableStreamTarget:
    """A catalog table partitioned by ``batch_id``, made at the first batch; a repeated batch overwrites its partition alone."""

    table: str
    columns: tuple
    source: str = "parquet"

    def batch(self, batch_id: int) -> _TableBatch:
        return _TableBatch(self, batch_id)


@dataclass(frozen=True)
class _TableBatch:
    target: TableStreamTarget
    batch_id: int
    atomic = True

    def write(self, loaded: DataFrame) -> None:
        spark: SparkSession = loaded.sparkSession
        rows = full_row(loaded, self.target.columns)
        if not spark.catalog.tableExists(self.target.table):
            empty = spark.createDataFrame([], rows.schema).withColumn(BATCH, F.lit(None).cast("bigint"))
            empty.write.format(self.target.source).partitionBy(BATCH).saveAsTable(self.target.table)
        spark.sql(
            f"INSERT OVERWRITE TABLE {self.target.table} PARTITION ({BATCH} = {int(self.batch_id)}) SELECT * FROM {{rows}}", rows=rows)


def _partition(path: str | None, batch_id: int) -> str | None:
    return path and f"{path.rstrip('/')}/{BATCH}={batch_id}"


def _native_writer(stream: DataFrame, spec: LoadSpec, target: NativeStreamTarget):
    stream.sparkSession.dataSource.register(NativeSink)
    rows = validate(stream, spec, passthrough=False)
    if spec.abort_on_error:
        rows = rows.with_checked(abort_on_reject(rows))
    options = sink_options(rows.loaded, target.path, target.columns)
    return wire_columns(rows.loaded, target.columns).writeStream.format(FORMAT).options(**options)


def stream_load(stream: DataFrame, spec: LoadSpec, target, checkpoint: str, trigger: dict | None = None,
                on_report=None) -> StreamingQuery:
    """Start loading a stream into a ``StreamTarget``, ``TableStreamTarget`` or ``NativeStreamTarget``.

    The checkpoint decides which rows belong to which batch, so a restarted query repeats the batch it
    was in. ``on_report(batch_id, report)`` gets the exact counts of every batch. With ``abort_on_error``
    a rejected row stops the query and its batch is not published.

    Into a native folder, without logs and reports, rows go through the format's own streaming sink, whose commits are by batch; else
    every batch is a load of its own.
    """
    errors = [r.text for r in check_load(stream.schema, spec) if r.level == "error"]
    if errors:
        raise LoadPlanError("; ".join(errors))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        batch_spec = replace(
            spec,
            rejected_path=_partition(spec.rejected_path, batch_id),
            exceptions_path=_partition(spec.exceptions_path, batch_id),
        )
        report = load(batch, batch_spec, target.batch(batch_id), log_mode="overwrite")
        if on_report:
            on_report(batch_id, report)

    if isinstance(target, NativeStreamTarget) and not (on_report or spec.rejected_path or spec.exceptions_path):
        writer = _native_writer(stream, spec, target)
    else:
        writer = stream.writeStream.foreachBatch(load_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    if spec.stream_name:
        writer = writer.queryName(spec.stream_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
