"""One job that writes accepted rows and both reject logs, and publishes all of them by one manifest.

A task writes its accepted rows as Parquet and its log entries side by side, each below ``_staging/<run>`` of the folder that they
belong to, where readers don't look. The commit writes the run's manifest, ``_loads/<run>.json`` of the target: from then
on the run counts. It names the files of the attempts that counted; these are then moved to their places. A driver that dies in
between leaves a manifest whose moves the next run, or ``finish``, completes; files of failed, repeated or lost attempts are
never named. Manifests stay as a ledger of the runs: a run that has one isn't done again.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from sluice.errors import LoadPlanError
from sluice.sources.native import filesystem, qualified

FORMAT = "routed_rows"
ACCEPTED, REJECTED, EXCEPTIONS, REASON = "accepted", "rejected", "exceptions", "reason"
ABORT_MARK, ABORT_END = "row rejected: ", " -- load aborted"
STAGING, LEDGER, FAILED = "_staging", "_loads", "failed-"
ROW_GROUP_BYTES = 64 << 20  # of Arrow data, before a row group is written
MOVERS = 32  # files that the driver moves at a time
RUN = re.compile("[A-Za-z0-9][A-Za-z0-9_.-]*")
SUFFIXES = {"parquet": ".snappy.parquet", "json": ".json", "text": ".txt"}
_PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BinaryType,
          T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _storable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _storable(kind.elementType)
    if isinstance(kind, T.MapType):
        return _storable(kind.keyType) and _storable(kind.valueType)
    if isinstance(kind, T.StructType):
        return storable(kind, False)
    return type(kind) in (*_PLAIN, T.CharType, T.VarcharType)


def storable(schema: T.StructType, intervals: bool = True) -> bool:
    """Whether tasks can write rows of this schema as Spark would: types that Arrow and Parquet share, and plain day-time intervals."""
    names = [f.name.lower() for f in schema.fields]
    return bool(names) and len(set(names)) == len(names) and all(
        _storable(f.dataType) or intervals and isinstance(f.dataType, T.DayTimeIntervalType) for f in schema.fields)


@dataclass
class TaskWritten(WriterCommitMessage):
    """Files of one attempt by output, its rows by output and its rejects by reason."""

    files: dict = field(default_factory=dict)
    rows: dict = field(default_factory=dict)
    reasons: dict = field(default_factory=dict)


class _ParquetFile:
    """Rows gathered into row groups of some size, in a file whose schema Spark reads back as it was."""

    def __init__(self, fs, path: str, schema: str, version: str):
        self.fs, self.path, self.metadata = fs, path, {
            "org.apache.spark.sql.parquet.row.metadata": schema, "org.apache.spark.version": version}
        self.out = self.writer = None
        self.held: list[pa.RecordBatch] = []
        self.size = 0

    def add(self, rows: pa.Array) -> None:
        batch = pa.RecordBatch.from_struct_array(rows)
        columns = [c.cast(pa.int64()) if pa.types.is_duration(c.type) else c for c in batch.columns]
        schema = pa.schema([pa.field(n, c.type) for n, c in zip(batch.schema.names, columns)], self.metadata)
        self.held.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        self.size += self.held[-1].nbytes
        if self.size >= ROW_GROUP_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.writer is None:
            self.out = self.fs.open_output_stream(self.path)
            self.writer = pq.ParquetWriter(self.out, self.held[0].schema, compression="snappy")
        self.writer.write_table(pa.Table.from_batches(self.held))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        if self.writer is not None:
            self.writer.close()
            self.out.close()


class _LineFile:
    """One line of text for each row."""

    def __init__(self, fs, path: str):
        self.out = fs.open_output_stream(path)

    def add(self, rows: pa.Array) -> None:
        self.out.write("".join(f"{line}\n" for line in rows.to_pylist()).encode())

    def close(self) -> None:
        self.out.close()


class RoutedWriter(DataSourceArrowWriter):
    """``settings``: run, roots of the outputs, which of them are overwritten, the logs' format, row schemas and whether a bad row aborts."""

    def __init__(self, settings: dict):
        self.settings = settings
        self.run, self.roots = settings["run"], settings["roots"]

    def _file(self, output: str, name: str):
        fs, root = filesystem(self.roots[output])
        kind = "parquet" if output == ACCEPTED else self.settings["log_format"]
        staged = posixpath.join(root, STAGING, self.run)
        fs.create_dir(staged, recursive=True)  # logs without entries leave no folder
        path = posixpath.join(staged, name + SUFFIXES[kind])
        if kind == "parquet":
            return _ParquetFile(fs, path, self.settings["schemas"][output], self.settings["version"])
        return _LineFile(fs, path)

    def _name(self, prefix: str = "part-") -> str:
        context = TaskContext.get()
        return f"{prefix}{context.partitionId():06d}-{self.run}-{context.taskAttemptId()}"

    def write(self, iterator):
        name, open_files, done = self._name(), {}, TaskWritten()
        reasons: Counter = Counter()
        try:
            for batch in iterator:
                reason = batch.column(REASON)
                bad = pc.is_valid(reason)
                if reason.null_count < len(reason):
                    if self.settings["abort"]:
                        self._fail(batch, bad.index(True).as_py())
                    reasons.update({e["values"]: e["counts"] for e in pc.value_counts(reason.drop_null()).to_pylist()})
                    self._limit(reasons)
                for output in self.roots:
                    rows = batch.column(output).filter(pc.invert(bad) if output == ACCEPTED else bad)
                    if len(rows):
                        if output not in open_files:
                            open_files[output] = self._file(output, name)
                        open_files[output].add(rows)
                        done.rows[output] = done.rows.get(output, 0) + len(rows)
        finally:
            for file in open_files.values():
                file.close()
        done.reasons = dict(reasons)
        done.files = {output: name for output in open_files}
        return done

    def _limit(self, reasons: Counter) -> None:
        """Fail when more rows were rejected than may be: in a task, which stops the job while it runs, or in all."""
        most = self.settings.get("most_rejects")
        if most is not None and reasons.total() > most:
            often = max(sorted(reasons), key=reasons.get)
            raise RuntimeError(f"{ABORT_MARK}more than {most} rejects, most often: {often}{ABORT_END}")

    def _fail(self, batch: pa.RecordBatch, at: int) -> None:
        """Log the first bad row of the task and fail with its reason."""
        for output in self.roots:
            if output != ACCEPTED:
                file = self._file(output, self._name(FAILED))
                file.add(batch.column(output).slice(at, 1))
                file.close()
        raise RuntimeError(f"{ABORT_MARK}{batch.column(REASON)[at].as_py()}{ABORT_END}")

    def _ending(self, output: str) -> str:
        return SUFFIXES["parquet" if output == ACCEPTED else self.settings["log_format"]]

    def commit(self, messages):
        written = [m for m in messages if m is not None]
        self._limit(sum((Counter(m.reasons) for m in written), Counter()))
        rows = {output: sum(m.rows.get(output, 0) for m in written) for output in self.roots}
        moves = [[output, m.files[output] + self._ending(output)] for m in written for output in m.files]
        if not rows[ACCEPTED]:  # readers find the schema
            empty = f"part-empty-{self.run}"
            file = self._file(ACCEPTED, empty)
            kind = _arrow_struct(T.StructType.fromJson(json.loads(self.settings["schemas"][ACCEPTED])))
            file.add(pa.array([], kind))
            file.close()
            moves.append([ACCEPTED, empty + self._ending(ACCEPTED)])
        reasons = sum((Counter(m.reasons) for m in written), Counter())
        removes = [[output, name] for output in self.settings["overwrite"] for name in _published(self.roots[output])]
        rejected = sum(reasons.values())
        publish({"run": self.run, "roots": self.roots, "rows_accepted": rows[ACCEPTED], "rows_rejected": rejected,
                 "reasons": dict(reasons), "removes": removes, "moves": moves})

    def abort(self, messages):
        """The log entries of one failing row are published, everything else goes."""
        first = None
        for output, root in self.roots.items():
            fs, folder = filesystem(root)
            staged = posixpath.join(folder, STAGING, self.run)
            failed = sorted(f.base_name for f in _listed(fs, staged) if f.base_name.startswith(FAILED))
            first = first or (failed[0].partition(".")[0] if failed else None)
            for name in failed:
                if name.partition(".")[0] == first:
                    _move(fs, posixpath.join(staged, name), posixpath.join(folder, "part-" + name.removeprefix(FAILED)))
            _remove_folder(fs, staged)


def _arrow_struct(schema: T.StructType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.struct(list(to_arrow_schema(schema)))


def _listed(fs, folder: str) -> list:
    return fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))


def _published(root: str) -> list[str]:
    """What readers of a folder see: its entries but for hidden ones, and the mark of a finished job."""
    fs, folder = filesystem(root)
    return [f.base_name for f in _listed(fs, folder) if f.base_name[:1] not in "._"]


def _exists(fs, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def _move(fs, source: str, place: str) -> None:
    """Move a file, unless an earlier try has."""
    if _exists(fs, source):
        fs.move(source, place)
    elif not _exists(fs, place):
        raise FileNotFoundError(f"{source} is neither there nor at {place}")


def _remove(fs, path: str) -> None:
    kind = fs.get_file_info(path).type
    if kind == pafs.FileType.Directory:
        fs.delete_dir(path)
    elif kind != pafs.FileType.NotFound:
        fs.delete_file(path)


def _remove_folder(fs, path: str) -> None:
    if _exists(fs, path):
        fs.delete_dir(path)


def publish(manifest: dict) -> None:
    """Put a run's manifest in its place, whole, and then its files."""
    fs, folder = filesystem(manifest["roots"][ACCEPTED])
    ledger = posixpath.join(folder, LEDGER)
    fs.create_dir(ledger, recursive=True)
    draft = posixpath.join(ledger, f".{manifest['run']}")
    with fs.open_output_stream(draft) as out:
        out.write(json.dumps(manifest).encode())
    fs.move(draft, posixpath.join(ledger, f"{manifest['run']}.json"))  # published
    _complete(manifest)


def _complete(manifest: dict) -> None:
    places = {output: filesystem(root) for output, root in manifest["roots"].items()}

    def remove(entry):
        fs, folder = places[entry[0]]
        _remove(fs, posixpath.join(folder, entry[1]))

    def move(entry):
        fs, folder = places[entry[0]]
        _move(fs, posixpath.join(folder, STAGING, manifest["run"], entry[1]), posixpath.join(folder, entry[1]))

    with ThreadPoolExecutor(MOVERS) as movers:
        list(movers.map(remove, manifest["removes"]))
        list(movers.map(move, manifest["moves"]))
    for fs, folder in places.values():
        _remove_folder(fs, posixpath.join(folder, STAGING, manifest["run"]))


def ledger_entry(path: str, run: str) -> dict | None:
    """The manifest of a run, if it was published."""
    fs, folder = filesystem(path)
    place = posixpath.join(folder, LEDGER, f"{run}.json")
    if not _exists(fs, place):
        return None
    with fs.open_input_stream(place) as stream:
        return json.loads(stream.readall())


def finish(path: str) -> list[str]:
    """Complete runs into a folder that were published but whose files weren't all moved; their names."""
    fs, folder = filesystem(path)
    found = []
    for staged in _listed(fs, posixpath.join(folder, STAGING)):
        manifest = ledger_entry(path, staged.base_name)
        if manifest:
            _complete(manifest)
            found.append(manifest["run"])
    return found


class RoutedSink(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        return RoutedWriter(json.loads(self.options["settings"]))


def checked_run(run: str | None) -> str:
    if run is not None and not RUN.fullmatch(run):
        raise LoadPlanError(f"a load id holds letters, digits, dots, dashes and underscores, not {run!r}")
    return run or uuid4().hex


def write_routed(rows: DataFrame, run: str, roots: dict, overwrite: list[str], log_format: str = "parquet", abort: bool = False,
                 most_rejects: int | None = None) -> dict:
    """Write rows of a column ``reason``, null for accepted ones, and a column for each output that ``roots`` names; returns the manifest.

    ``accepted`` and, for logs in Parquet, ``rejected`` and ``exceptions`` are structs, else lines of text. ``overwrite``
    names outputs whose earlier files go when the run is published. With ``abort`` the first bad row of a task fails the job;
    nothing is published then but that row's log entries. With ``most_rejects`` nothing is published if more rows have a reason; the
    first task that sees so many by itself fails the job.
    """
    spark = rows.sparkSession
    spark.dataSource.register(RoutedSink)
    roots = {output: qualified(spark, root) for output, root in roots.items()}
    for root in roots.values():
        filesystem(root)  # refuses schemes that tasks can't write to before any job
    schemas = {o: rows.schema[o].dataType.json() for o in roots if isinstance(rows.schema[o].dataType, T.StructType)}
    settings = {"run": run, "roots": roots, "overwrite": overwrite, "log_format": log_format, "abort": abort, "schemas": schemas,
                "version": spark.version, "most_rejects": most_rejects}
    rows.select(F.col(REASON), *(F.col(o) for o in roots)).write.format(FORMAT).mode("append").option("settings", json.dumps(settings)).save()
    return ledger_entry(roots[ACCEPTED], run)
