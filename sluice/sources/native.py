"""Native binary datasets: one self-contained file per writing task, and a manifest per run.

Tasks write files under their final names, which hold the run and the attempt. The driver's commit only writes the
manifest, which names the files of the attempts that counted; readers take files from manifests alone. So nothing is moved, a
run without manifest is not published, and files of failed, repeated or lost attempts are never read; commit and
abort remove those they find.

A manifest has one JSON object per line: the first holds the run, the runs that it replaces and the columns, the others a
file each, with the marks that readers split it at. Beside each file stand the sizes of its rows.

A stream's batch is a run in a folder of its own, so that its commit lists no other's files.
"""

from __future__ import annotations

import json
import posixpath
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from sluice.errors import LoadPlanError
from sluice.functions import wire
from sluice.operators.mapping import column
from sluice.plans.spec import TargetColumn
from sluice.sources.native_read import NativeReader, dataset_columns, declared, schema_of

FORMAT = "native_rows"
MANIFEST = "manifest-"
MANIFEST_SCHEMA = "run string, replaces array<string>, file string, rows bigint, bytes bigint"
SUFFIX, SIZES = ".bin", ".sizes"
SPLIT_BYTES = 32 << 20  # of a file between two marks, at least
BATCH_ID = "streaming.sql.batchId"  # Spark's property of the tasks of a micro-batch
REMOVERS = 32  # files the driver removes at a time
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}  # names that Spark and Arrow have for the same stores
SCHEME = re.compile("[A-Za-z][A-Za-z0-9+.-]*:")
READ_BYTES = 1 << 22


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a plain path or a URI (file, hdfs, s3, ...); other schemes are refused."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path.rstrip("/")
    scheme, separator, rest = path.partition("://")
    if not separator:
        raise LoadPlanError(f"files cannot be written to {path}: it is neither a path nor a URI with a host")
    try:
        fs, inner = pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as error:
        raise LoadPlanError(f"files cannot be written to {path}: {error}") from error
    return fs, inner.rstrip("/")


def qualified(spark, path: str) -> str:
    """A plain path is on the cluster's default file system, for Spark and so for us."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return path if SCHEME.match(path) else default.rstrip("/") + path


@dataclass
class PartWritten(WriterCommitMessage):
    name: str | None
    rows: int
    bytes: int
    marks: list = field(default_factory=list)
    sizes: str | None = None


class _Run:
    """Files of one run below a folder of a dataset, and their manifest. A run that names no columns isn't read as values and keeps no sizes."""

    def __init__(self, path: str, run: str, widths: list[int], columns: list | None, folder: str = ""):
        self.path, self.run, self.widths, self.columns, self.folder = path, run, widths, columns, folder

    def write(self, iterator):
        context = TaskContext.get()
        fs, root = filesystem(self.path)
        root = posixpath.join(root, self.folder)
        if self.folder:
            fs.create_dir(root, recursive=True)
        name = f"part-{context.partitionId():06d}-{self.run}-{context.taskAttemptId()}"
        rows = size = 0
        marks: list = []
        out = sizes = None
        try:
            for batch in iterator:
                for piece in wire.slices(batch):
                    if out is None:  # tasks without rows leave no file
                        out = fs.open_output_stream(posixpath.join(root, name + SUFFIX))
                        sizes = fs.open_output_stream(posixpath.join(root, name + SIZES)) if self.columns else None
                        header = wire.file_header(self.widths)
                        out.write(header)
                        size += len(header)
                        marks.append([0, size])
                    encoded = wire.encode_batch(piece, self.widths)
                    lengths = pc.binary_length(encoded).to_numpy(zero_copy_only=False).astype(np.int64)
                    if sizes is not None:
                        sizes.write(lengths.astype("<u4").tobytes())
                    out.write(wire.joined_bytes(encoded))
                    marks += [[rows + int(i) + 1, size + int(end)] for i, end in _marked(lengths, size - marks[-1][1])]
                    rows += piece.num_rows
                    size += int(lengths.sum())
        finally:
            for file in (out, sizes):
                if file is not None:
                    file.close()
        if out is None:
            return PartWritten(None, 0, 0)
        if marks[-1][0] < rows:
            marks.append([rows, size])
        kept = posixpath.join(self.folder, name + SIZES) if self.columns else None
        return PartWritten(posixpath.join(self.folder, name + SUFFIX), rows, size, marks if kept else [], kept)

    def publish(self, messages, old: list[dict] = ()) -> None:
        """Write the manifest in place of the run's earlier one, and remove files of the run that it doesn't name."""
        fs, root = filesystem(self.path)
        files = [{"run": self.run, "file": m.name, "rows": m.rows, "bytes": m.bytes, "sizes": m.sizes, "marks": m.marks}
                 for m in messages if m is not None and m.name]
        lines = [{"run": self.run, "replaces": [m["run"] for m in old], "columns": self.columns}, *files]
        draft = posixpath.join(root, f".{MANIFEST}{self.run}")
        with fs.open_output_stream(draft) as out:
            for line in lines:
                out.write(json.dumps(line).encode() + b"\n")
        fs.move(draft, posixpath.join(root, f"{MANIFEST}{self.run}.json"))  # published
        _remove(fs, [posixpath.join(root, f"{MANIFEST}{m['run']}.json") for m in old])
        _remove(fs, [posixpath.join(root, name) for m in old for f in m["files"] for name in _names(f)])
        self.tidy({name for f in files for name in _names(f)})

    def tidy(self, published: set[str]) -> None:
        fs, root = filesystem(self.path)
        _remove(fs, _files_of(fs, posixpath.join(root, self.folder), self.run, {posixpath.basename(name) for name in published}))


def _names(file: dict) -> list[str]:
    return [file["file"], *([file["sizes"]] if file.get("sizes") else [])]


def _marked(lengths: np.ndarray, since: int):
    """Rows of a piece, and their ends in it, after which ``SPLIT_BYTES`` have come together since the last mark."""
    ends = np.cumsum(lengths)
    base = -since
    while len(ends):
        i = int(np.searchsorted(ends, base + SPLIT_BYTES))
        if i >= len(ends):
            return
        yield i, ends[i]
        base = int(ends[i])


class NativeWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str, widths: list[int], overwrite: bool, columns: list | None = None):
        self.files, self.overwrite = _Run(path, run, widths, columns), overwrite

    def write(self, iterator):
        return self.files.write(iterator)

    def commit(self, messages):
        old = []
        if self.overwrite:
            old = [m for m in _manifests(*filesystem(self.files.path)) if m["run"] != self.files.run]
        self.files.publish(messages, old)

    def abort(self, messages):
        manifests = _manifests(*filesystem(self.files.path))
        self.files.tidy({name for m in manifests if m["run"] == self.files.run for f in m["files"] for name in _names(f)})


class NativeStreamWriter(DataSourceStreamArrowWriter):
    """Each micro-batch is a run, ``batchN``, in a folder of that name. A batch that is repeated publishes its run again in place of its first try."""

    def __init__(self, path: str, widths: list[int], columns: list):
        self.path, self.widths, self.columns = path, widths, columns

    def _run(self, batch) -> _Run:
        return _Run(self.path, f"batch{batch}", self.widths, self.columns, f"batch{batch}")

    def write(self, iterator):
        return self._run(int(TaskContext.get().getLocalProperty(BATCH_ID))).write(iterator)

    def commit(self, messages, batchId):
        self._run(batchId).publish(messages)

    def abort(self, messages, batchId):
        fs, root = filesystem(self.path)
        run = self._run(batchId)
        manifest = _manifest(fs, posixpath.join(root, f"{MANIFEST}{run.run}.json"))
        run.tidy({name for f in (manifest["files"] if manifest else []) for name in _names(f)})


def _listed(fs, root):
    return fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))


def _files_of(fs, root, run: str, published: set[str]) -> list[str]:
    """Files of a run that its manifest doesn't name."""
    return [f.path for f in _listed(fs, root) if f.base_name.startswith("part-") and f"-{run}-" in f.base_name
            and f.base_name not in published]


def _remove(fs, paths: list[str]) -> None:
    def remove(path):
        try:
            fs.delete_file(path)
        except FileNotFoundError:
            pass  # an earlier try removed it

    with ThreadPoolExecutor(REMOVERS) as removers:
        list(removers.map(remove, paths))


def _manifest(fs, path: str) -> dict | None:
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    with fs.open_input_stream(path) as stream:
        head, *files = [json.loads(line) for line in stream.readall().splitlines()]
    return {**head, "rows": sum(p["rows"] for p in files), "bytes": sum(p["bytes"] for p in files), "files": files}


def _manifests(fs, root) -> list[dict]:
    places = [f.path for f in _listed(fs, root) if f.base_name.startswith(MANIFEST)]
    with ThreadPoolExecutor(REMOVERS) as readers:
        found = [m for m in readers.map(lambda place: _manifest(fs, place), places) if m]
    replaced = {run for m in found for run in m["replaces"]}
    return sorted((m for m in found if m["run"] not in replaced), key=lambda m: m["run"])


class NativeSink(DataSource):
    """``native_rows``: written by loads and streams; read with the option ``path``, all columns or those of a given schema."""

    @classmethod
    def name(cls):
        return FORMAT

    def _described(self) -> tuple[list[int], list]:
        columns = json.loads(self.options["columns"])
        return [wire.wire_width(TargetColumn(*c)) for c in columns], columns

    def writer(self, schema, overwrite):
        widths, columns = self._described()
        return NativeWriter(self.options["path"], self.options["run"], widths, overwrite, columns)

    def streamWriter(self, schema, overwrite):
        return NativeStreamWriter(self.options["path"], *self._described())

    def schema(self):
        return schema_of(dataset_columns(read_manifests(self.options["path"])))

    def reader(self, schema):
        manifests = read_manifests(self.options["path"])
        columns = dataset_columns(manifests)
        kinds = {c.name: c.spark_type for c in columns}
        wrong = [f.name for f in schema.fields if kinds.get(f.name) != f.dataType]
        if wrong or not schema.fields:
            raise LoadPlanError(f"not columns of the dataset in this type: {', '.join(wrong)}")
        return NativeReader(self.options["path"], columns, schema.names, manifests)


def wire_columns(loaded: DataFrame, columns) -> DataFrame:
    """The plain columns that are put into bytes, for the target columns present in ``loaded``."""
    return loaded.select([wire.wire_value(column(c.name), c).alias(c.name) for c in _present(loaded, columns)])


def _present(loaded: DataFrame, columns):
    by_name = {c.name: c for c in columns}
    return [by_name[name] for name in loaded.columns]


def _widths(loaded: DataFrame, columns) -> list[int]:
    return [wire.wire_width(c) for c in _present(loaded, columns)]


@dataclass(frozen=True)
class NativeTarget:
    """Native files of the loaded columns, for ``plans.load.load`` or on their own.

    A ``run`` that is given is published again in place of its earlier try.
    """

    path: str
    columns: tuple
    mode: str = "append"
    run: str | None = None
    atomic = True

    def write(self, loaded: DataFrame) -> None:
        spark = loaded.sparkSession
        spark.dataSource.register(NativeSink)
        options = sink_options(loaded, self.path, self.columns)
        (
            wire_columns(loaded, self.columns).write.format(FORMAT).mode(self.mode).options(**options)
            .option("run", self.run or uuid4().hex).save()
        )


def sink_options(loaded: DataFrame, path: str, columns) -> dict[str, str]:
    """Options of the sink for the loaded columns; the folder is made."""
    wire.file_header(_widths(loaded, columns))  # refuses too many columns before any job
    path = qualified(loaded.sparkSession, path)
    fs, root = filesystem(path)  # and schemes it cannot write to
    fs.create_dir(root, recursive=True)
    return {"path": path, "columns": json.dumps([declared(c) for c in _present(loaded, columns)])}


def encode_rows(loaded: DataFrame, columns, name: str = "row_bytes") -> DataFrame:
    """The bytes of every row as a BINARY column, without files."""
    widths = _widths(loaded, columns)

    def encode(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in wire.slices(batch):
                yield pa.RecordBatch.from_arrays([wire.encode_batch(piece, widths).cast(pa.binary())], [name])

    schema = T.StructType([T.StructField(name, T.BinaryType(), False)])
    return wire_columns(loaded, columns).mapInArrow(encode, schema)


def header_size(columns: int) -> int:
    return len(wire.file_header([0] * columns))


def published_files(spark, path: str) -> DataFrame:
    """run, file, rows and bytes of the published files, from the manifests."""
    lines = spark.read.schema(MANIFEST_SCHEMA).option("pathGlobFilter", f"{MANIFEST}*.json").json(path)
    replaced = lines.select(F.explode("replaces").alias("run"))
    files = lines.where(F.col("file").isNotNull()).join(replaced, "run", "left_anti")
    return files.select("run", "file", "rows", "bytes")


def published_bytes(spark, path: str, columns: int) -> DataFrame:
    """One row: the published files of a native dataset and the bytes of their rows."""
    return published_files(spark, path).agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum(F.col("bytes") - header_size(columns)), F.lit(0)).alias("row_bytes"),
    )


def published_rows(spark, path: str, columns: int) -> DataFrame:
    """The bytes of every published row, read back from the files that the manifests name, one task for each file."""
    root, flags = qualified(spark, path), (columns + 7) // 8

    def read(batches):
        for batch in batches:
            for name in batch.column("file").to_pylist():
                fs, folder = filesystem(root)
                with fs.open_input_stream(posixpath.join(folder, name)) as data:
                    data.read(header_size(columns))
                    rest = b""
                    while more := data.read(READ_BYTES):
                        rows, rest = wire.split_rows(rest + more, flags)
                        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["row_bytes"])
                    if rest:
                        raise ValueError(f"file {name} ends within a row")

    files = published_files(spark, path).select("file")
    return files.repartition("file").mapInArrow(read, T.StructType([T.StructField("row_bytes", T.BinaryType())]))


def read_manifests(path: str) -> list[dict]:
    """Manifests of the published runs."""
    return _manifests(*filesystem(path))
