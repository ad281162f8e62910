"""The load itself: check, map, conform, write, report."""

from __future__ import annotations

import re
from contextlib import ExitStack
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from sluice.errors import LoadAborted, LoadPlanError
from sluice.functions.conform import conform, to_text
from sluice.operators.mapping import column, resolve_mapping
from sluice.operators.rejects import NULL_TEXT, CheckedRows, count_columns, validate
from sluice.plans.evolve import evolve_target, fits
from sluice.plans.spec import LoadSpec
from sluice.sources import routed
from sluice.sources.native import qualified
from sluice.sources.routed import ABORT_END, ABORT_MARK
from sluice.sources.target import PathTarget, TableTarget, columns_from_table, create_target
from sluice.sources.workspace import scratch, write_table

AUTO = "auto"
# plan steps that hand on rows in the order in which they get them, or make them in a fixed one
ORDERED_STEPS = ("Project", "Filter", "Generate", "Expand", "CollectMetrics", "Range", "LocalRelation", "OneRowRelation", "Union")
FILES = "HadoopFsRelation"
RANGE_BYTES = 32 << 20  # of a range that rows are sorted in, as files hold them; rows in memory take many times that
UNKNOWN_SIZE = 1 << 60
_TIE = "__load_arrival"


@dataclass(frozen=True)
class LoadReport:
    """Exact counts of one load; ``reasons`` counts rejects by reason where one job wrote rows and logs."""

    rows_read: int
    rows_accepted: int
    rows_rejected: int
    reasons: dict = field(default_factory=dict, compare=False)

    @classmethod
    def of(cls, metrics: dict) -> LoadReport:
        return cls(metrics["rows_read"], metrics["rows_accepted"], metrics["rows_rejected"])


@dataclass(frozen=True)
class Remark:
    """One finding of the check before a load; errors stop it, warnings do not."""

    level: str
    text: str


def check_load(schema: T.StructType, spec: LoadSpec) -> list[Remark]:
    """What is wrong or noteworthy about loading a stream of this schema. Runs no job."""
    try:
        mapped = resolve_mapping(schema, spec)
    except LoadPlanError as error:
        return [Remark("error", str(error))]
    remarks = []
    if not mapped:
        remarks.append(Remark("error", "no fields to load"))
    for m in mapped:
        try:
            conform(column(m.source.name), m.source.dataType, m.target, spec.time_zone, spec.precision)
        except LoadPlanError as error:
            remarks.append(Remark("error", f"field {m.source.name}: {error}"))
    used_fields = {m.source.name for m in mapped}
    used_columns = {m.target.name for m in mapped}
    for f in schema.fields:
        if f.name not in used_fields:
            remarks.append(Remark("warning", f"field {f.name} is not loaded"))
    for c in spec.columns:
        if c.name not in used_columns:
            remarks.append(Remark("warning", f"column {c.name} gets no value from the stream"))
    return remarks


def check_table(spark: SparkSession, spec: LoadSpec, table: str) -> list[Remark]:
    """Where a table as it is now clashes with the columns of a load into it, in both directions. Runs no job."""
    try:
        live = {c.name.lower(): c for c in columns_from_table(spark, table)}
    except LoadPlanError as error:
        return [Remark("error", str(error))]
    loaded = {c.name.lower(): c for c in spec.columns} if spec.fields is None else {
        c.name.lower(): c for c in map(spec.column, [name for _, name in spec.fields]) if c}
    remarks = []
    for name, c in loaded.items():
        if name not in live:
            remarks.append(Remark("error", f"table {table} has no column {c.name}"))
        elif not fits(c, live[name]):
            remarks.append(Remark("error", f"column {c.name}: {c.type_text} does not fit the table's {live[name].type_text}"))
    needed = {f.name.lower() for f in spark.table(table).schema.fields if not f.nullable}
    for name, c in live.items():
        if name not in loaded:
            level = "error" if name in needed else "warning"
            remarks.append(Remark(level, f"the table's column {c.name} is not loaded" + (" and takes no NULL" if name in needed else "")))
    return remarks


def _require_loadable(df: DataFrame, spec: LoadSpec) -> None:
    errors = [r.text for r in check_load(df.schema, spec) if r.level == "error"]
    if errors:
        raise LoadPlanError("; ".join(errors))


def _content_hashes(df: DataFrame) -> list[Column]:
    """Two independent hashes over all fields of a row."""
    values = [column(f.name).cast("string") if "map<" in f.dataType.simpleString() else column(f.name) for f in df.schema]
    return [F.xxhash64(*values), F.hash(*values)]


def arrives_in_order(df: DataFrame) -> bool:
    """Whether a task that is run again is sure to see its rows in the same order.

    That holds for files under steps that work row by row with functions that always give the same. All else, such as
    shuffles, caches, RDDs, Python steps and connectors, counts as unordered.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if not plan.deterministic():
        return False
    steps = [plan]
    while steps:
        step = steps.pop()
        kind = step.nodeName()
        if kind == "LogicalRelation" or step.getClass().getSimpleName() == "LogicalRelation":
            if step.relation().getClass().getSimpleName() != FILES:
                return False
        elif kind not in ORDERED_STEPS:
            return False
        children = step.children()
        steps.extend(children.apply(i) for i in range(children.size()))
    return True


def range_count(df: DataFrame, least: int | None = None) -> int:
    """Number of ranges to sort rows in: by the plan's estimate of their size, and ``least`` or the session's shuffle partitions at least.

    So what a task sorts doesn't grow with the input. It only shapes the layout of files. A size that Spark doesn't know doesn't count.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    ranges = least or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges if size >= UNKNOWN_SIZE else max(ranges, -(-size // RANGE_BYTES))


def steady(df: DataFrame) -> DataFrame:
    """The rows in an order that a task which is run again finds too."""
    return df if arrives_in_order(df) else df.sortWithinPartitions(*_content_hashes(df))


def cluster(df: DataFrame, columns, partitions: int | None = None) -> DataFrame:
    """Rows sorted into ranges of some columns, ``partitions`` or more of them (see ``range_count``); without columns they stay where they are.

    Ties are numbered and split, so a key with very many rows, or copies of one row, spread over several
    tasks. A task that is run again has to give every row the number it had, or rows would be lost or
    doubled between two runs; input that may come in another order is sorted by content first.
    """
    if not columns:
        return df
    order = [column(c) for c in columns] + [F.col(_TIE)]
    tied = steady(df).withColumn(_TIE, F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(range_count(df, partitions), *order)
    return ranged.sortWithinPartitions(*order).drop(_TIE)


def abort_on_reject(rows: CheckedRows) -> DataFrame:
    """The checked rows; the first bad one a task meets fails the job with its reason."""
    failure = F.raise_error(F.concat(F.lit(ABORT_MARK), rows.reason, F.lit(ABORT_END))).cast("boolean")
    return rows.checked.where(F.when(rows.is_bad, failure).otherwise(F.lit(True)))


def log_entry(text: Column, zone: str) -> Column:
    """One time-stamped entry of a text log."""
    return F.concat_ws(" - ", to_text(F.col("rejected_at"), T.TimestampType(), zone), text)


def _exception_text(reason, value) -> Column:
    return F.concat_ws(": ", reason, F.coalesce(value, F.lit(NULL_TEXT)))


def _write_reject_logs(df: DataFrame, spec: LoadSpec, expected: int | None, mode: str) -> None:
    """Second pass over the input, taken only when rows were rejected and somebody wants to see them."""
    if not (spec.rejected_path or spec.exceptions_path):
        return
    rows = validate(df, spec, passthrough=True)
    seen = Observation(f"rejects-{uuid4().hex}")
    bad = rows.bad_rows().observe(seen, F.count(F.lit(1)).alias("rows"))
    if spec.rejected_path and spec.exceptions_path:
        bad = bad.persist(StorageLevel.DISK_ONLY)  # the second log needs no other pass, unless an executor is lost
    rows = rows.with_checked(bad)
    try:
        _write_logs(rows, spec, mode)
    finally:
        bad.unpersist()
    logged = seen.get["rows"]
    if expected is not None and logged != expected:
        raise RuntimeError(
            f"{expected} rows were rejected but {logged} logged: the input is not the same on every read; "
            "load it with stage=True"
        )


def _write_logs(rows: CheckedRows, spec: LoadSpec, mode: str) -> None:
    rejected, exceptions = rows.rejected, rows.exceptions
    if spec.log_format == "text":
        rejected = rejected.select(log_entry(F.col("rejected_line"), spec.time_zone))
        exceptions = exceptions.select(log_entry(_exception_text("reason", "value"), spec.time_zone))
    if spec.rejected_path:
        rejected.write.format(spec.log_format).mode(mode).save(spec.rejected_path)
    if spec.exceptions_path:
        exceptions.write.format(spec.log_format).mode(mode).save(spec.exceptions_path)


def spread(df: DataFrame, parallelism: int | str | None) -> DataFrame:
    """Rows in turn to so many tasks; ``"auto"`` lets adaptive execution pick tasks of even size."""
    if parallelism == AUTO:
        return df.hint("rebalance")
    return df.repartition(parallelism) if parallelism else df


def load(df: DataFrame, spec: LoadSpec, target, parallelism: int | str | None = None, cluster_by=(),
         stage: bool = False, create: bool = False, log_mode: str = "append", load_id: str | None = None,
         evolve: bool = False) -> LoadReport:
    """Load the rows that fit into ``target`` and log the others.

    One pass over the input conforms, counts and writes. Into Parquet files the same tasks write the reject logs, and one
    manifest publishes all; other targets' logs are written by a second pass, and only if there are any rejects.
    With ``abort_on_error`` the first bad row fails the write before anything is
    published; the reject logs are still written, and LoadAborted is raised. Without it, ``spec.most_rejects`` is a limit: LoadAborted
    is raised and nothing is published, logs neither, if more rows are rejected. The input is read once all the same.

    A load with a ``load_id``, into Parquet files, is done once: if its manifest is there, its report is returned and nothing
    is read, so a load that is repeated after a driver failure doesn't double its rows.

    Rows are written where they are read, without a shuffle. ``parallelism`` (a number of tasks, or
    ``"auto"`` for files of even size) spreads them first, which helps where a few input files hold most
    rows; ``cluster_by`` sorts them into ranges of target columns, more than ``parallelism`` of them where these would be large. ``stage`` writes the input to the
    shared folder first, for input that is costly to compute or differs between reads. ``create`` makes
    the target table if it does not exist; other targets make themselves. ``evolve`` gives an existing table the columns that
    it lacks before anything is read. A table that still clashes with the columns loaded is refused. Staged rows are removed when the load ends.
    """
    _require_loadable(df, spec)
    if load_id is not None:
        done = _done_before(df, target, routed.checked_run(load_id), cluster_by, spec)
        if done:
            return done
    if create or evolve:
        if not isinstance(target, TableTarget):
            raise LoadPlanError(f"{'create' if create else 'evolve'} is for catalog tables, not a {type(target).__name__}")
        if evolve and df.sparkSession.catalog.tableExists(target.table):
            evolve_target(df.sparkSession, target.table, spec.columns)
        else:
            create_target(df.sparkSession, target.table, spec.columns)
    if isinstance(target, TableTarget):
        clashes = [r.text for r in check_table(df.sparkSession, spec, target.table) if r.level == "error"]
        if clashes:
            raise LoadPlanError("; ".join(clashes))
    with ExitStack() as stack:
        if stage:
            if not (spec.rejected_path or spec.exceptions_path):  # the logs show every field
                mapped = {m.source.name for m in resolve_mapping(df.schema, spec)}
                if spec.fields:
                    df = df.select([column(f) for f in df.columns if f in mapped])
            df = write_table(df, stack.enter_context(scratch(df.sparkSession, "staged")))
        return _load(df, spec, target, parallelism, cluster_by, log_mode, load_id)


def _routable(schema: T.StructType, spec: LoadSpec, target) -> bool:
    """Whether one job can write the target and the logs: Parquet files, whose writer Spark's options don't concern."""
    return (type(target) is PathTarget and target.format == "parquet" and not target.options and target.mode in ("append", "overwrite")
            and (routed.storable(schema) or not (spec.rejected_path and spec.log_format == "parquet")))


def _done_before(df: DataFrame, target, run: str, cluster_by, spec: LoadSpec) -> LoadReport | None:
    if not _routable(df.schema, spec, target) or spec.abort_on_error and (cluster_by or spec.abort_log == "all" and (
            spec.rejected_path or spec.exceptions_path)):
        raise LoadPlanError("only loads that write Parquet files and their logs in one job have a load id")
    return _report_of(routed.ledger_entry(qualified(df.sparkSession, target.path), run))


def _report_of(manifest: dict | None) -> LoadReport | None:
    if manifest is None:
        return None
    accepted, rejected = manifest["rows_accepted"], manifest["rows_rejected"]
    return LoadReport(accepted + rejected, accepted, rejected, manifest["reasons"])


def _routed_rows(rows: CheckedRows, target: PathTarget) -> DataFrame:
    """Each checked row as what is written of it: the target's row, or the reason and the entries of the logs."""
    spec, zone = rows.spec, rows.spec.time_zone
    loaded = {m.target.name: c for m, c in zip(rows.mapped, rows.loaded_columns())}
    accepted = [loaded[c.name] if c.name in loaded else F.lit(None).cast(c.spark_type).alias(c.name) for c in target.columns]
    out = [rows.reason.alias(routed.REASON), F.when(rows.is_good, F.struct(*accepted)).alias(routed.ACCEPTED)]
    for path, name, columns in ((spec.rejected_path, routed.REJECTED, rows.rejected_columns()),
                                (spec.exceptions_path, routed.EXCEPTIONS, rows.exception_columns())):
        if path:
            entry = F.struct(*columns)
            if spec.log_format == "json":
                entry = F.to_json(entry)
            elif spec.log_format == "text":
                text = rows.line() if name == routed.REJECTED else _exception_text(rows.reason, rows.failing_value())
                entry = F.concat_ws(" - ", to_text(F.current_timestamp(), T.TimestampType(), zone), text)
            out.append(F.when(rows.is_bad, entry).alias(name))
    return rows.checked.select(out)


def _load_routed(df: DataFrame, spec: LoadSpec, target: PathTarget, parallelism, cluster_by, log_mode: str, load_id) -> LoadReport:
    """One job for rows and logs. Its tasks count what they write, so the counts are those of the attempts that counted."""
    spark = df.sparkSession
    routed.finish(qualified(spark, target.path))
    logs = {routed.REJECTED: spec.rejected_path, routed.EXCEPTIONS: spec.exceptions_path}
    rows = validate(df if cluster_by else spread(df, parallelism), spec, passthrough=bool(spec.rejected_path))
    rows = rows.with_checked(cluster(rows.checked, [_loaded_column(rows, c) for c in cluster_by], None if parallelism == AUTO else parallelism))
    roots = {routed.ACCEPTED: target.path, **{name: path for name, path in logs.items() if path}}
    overwrite = [routed.ACCEPTED] * (target.mode == "overwrite") + [name for name in roots if name in logs] * (log_mode == "overwrite")
    try:
        manifest = routed.write_routed(_routed_rows(rows, target), routed.checked_run(load_id), roots, overwrite, spec.log_format, spec.abort_on_error,
                                       None if spec.abort_on_error else spec.most_rejects)
    except Exception as error:
        raise _aborted(error) or error from error
    return _report_of(manifest)


def _aborted(error: Exception) -> LoadAborted | None:
    """The abort that a failed write tells of, if a bad row failed it."""
    found = re.search(re.escape(ABORT_MARK) + "(.*?)" + re.escape(ABORT_END), str(error))
    return found and LoadAborted(f"a row was rejected ({found[1]}); nothing was loaded", found[1])


def _load(df: DataFrame, spec: LoadSpec, target, parallelism, cluster_by, log_mode: str, load_id: str | None) -> LoadReport:
    logged = spec.rejected_path or spec.exceptions_path
    in_one_job = not (cluster_by or spec.abort_log == "all") if spec.abort_on_error else True  # a clustered load aborts before it shuffles
    limited = spec.most_rejects is not None and not spec.abort_on_error
    if limited and not _routable(df.schema, spec, target):
        raise LoadPlanError("only loads that write Parquet files and their logs in one job have a limit of rejects")
    if load_id is not None or limited or logged and in_one_job and _routable(df.schema, spec, target):
        return _load_routed(df, spec, target, parallelism, cluster_by, log_mode, load_id)

    # spread before conforming, so that the conversions run in all writing tasks too
    rows = validate(df if cluster_by else spread(df, parallelism), spec, passthrough=False, barrier=bool(cluster_by))

    if spec.abort_on_error and not target.atomic:
        report = LoadReport.of(rows.counts().first().asDict())
        if report.rows_rejected:
            _write_reject_logs(df, spec, report.rows_rejected, log_mode)
            raise LoadAborted(f"{report.rows_rejected} of {report.rows_read} rows do not fit; nothing was loaded")

    # counted in the task that writes, so that a lost executor's rerun is not counted twice
    metrics = Observation(f"load-{uuid4().hex}")
    ranges = None if parallelism == AUTO else parallelism
    checked = rows.checked
    if spec.abort_on_error and cluster_by:  # before rows are sampled, shuffled and sorted
        checked = abort_on_reject(rows)
    checked = cluster(checked, [_loaded_column(rows, c) for c in cluster_by], ranges)
    counted = rows.with_checked(checked.observe(metrics, *count_columns()))
    if spec.abort_on_error and not cluster_by:
        counted = counted.with_checked(abort_on_reject(counted))
    try:
        target.write(counted.loaded)
    except Exception as error:
        aborted = _aborted(error)
        if not aborted:
            raise
        _write_reject_logs(df, spec, None, log_mode)
        raise aborted from error

    report = LoadReport.of(metrics.get)
    if report.rows_rejected:
        _write_reject_logs(df, spec, report.rows_rejected, log_mode)
    return report


def _loaded_column(rows: CheckedRows, name: str) -> str:
    for i, m in enumerate(rows.mapped):
        if m.target.name.lower() == name.lower():
            return f"__load_{i}"
    raise LoadPlanError(f"column [{name}] is not loaded, rows cannot be clustered by it")
