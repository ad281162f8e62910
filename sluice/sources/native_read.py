"""Reading native datasets: byte ranges of published files as partitions, decoded column by column.

The writer keeps the size of each row beside a file, and the manifest marks a row boundary every so many bytes. A partition
is the bytes between two marks, so a large file is read by many tasks; places of rows come from the sizes at once, without
walking from row to row. Within a block of rows each column is decoded for all of them in NumPy: its place in a row is the
sum of what stands before it. Columns that aren't wanted are passed over, and none after the last wanted one is looked at.

Files from before there were sizes are read whole, row by row.
"""

from __future__ import annotations

import json
import posixpath
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSourceReader, InputPartition

from sluice.errors import LoadPlanError
from sluice.functions import wire
from sluice.functions.epoch import EPOCH_2000_DAYS, EPOCH_2000_MICROS
from sluice.plans.spec import INTEGER_TYPES, TargetColumn

BLOCK_BYTES = 4 << 20  # of rows that are decoded together; indexes take some ten times as much


def declared(c: TargetColumn) -> list:
    return [c.name, c.type_name, c.length, c.scale, c.width, c.fixed]


def schema_of(columns) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.spark_type) for c in columns])


@dataclass
class Range(InputPartition):
    """Rows of a file between two marks; without sizes the whole file."""

    file: str
    start: int
    end: int
    first_row: int
    rows: int
    sizes: str | None


def ranges_of(manifests: list[dict]) -> list[Range]:
    found = []
    for m in manifests:
        for f in m["files"]:
            marks = f.get("marks")
            if not marks:
                found.append(Range(f["file"], 0, f["bytes"], 0, f["rows"], None))
                continue
            for (row, at), (next_row, end) in zip(marks, marks[1:]):
                found.append(Range(f["file"], at, end, row, next_row - row, f["sizes"]))
    return found


def _gathered(data: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some stretches, one after the other, and where each begins; with the end."""
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    return data[np.repeat(at - offsets[:-1], lengths) + np.arange(offsets[-1])], offsets


def _numbers(data: np.ndarray, at: np.ndarray, code: str) -> np.ndarray:
    width = np.dtype(code).itemsize
    return np.ascontiguousarray(data[at[:, None] + np.arange(width)]).view(code).ravel()


def _value(c: TargetColumn, data: np.ndarray, at: np.ndarray, lengths: np.ndarray, nulls: np.ndarray) -> pa.Array:
    """One column of a block: ``at`` and ``lengths`` are those of the values that aren't null."""
    valid = ~nulls
    kind = c.type_name
    if wire.is_variable(c) or kind in ("CHAR", "BINARY"):
        raw, ends = _gathered(data, at, lengths)
        offsets = np.zeros(len(nulls) + 1, np.int32)
        sizes = np.zeros(len(nulls), np.int32)
        sizes[valid] = lengths
        np.cumsum(sizes, out=offsets[1:])
        mask = pa.py_buffer(np.packbits(valid, bitorder="little"))
        text = kind in ("CHAR", "VARCHAR", "NUMERIC")
        found = pa.Array.from_buffers(pa.string() if text else pa.binary(), len(nulls), [mask, pa.py_buffer(offsets), pa.py_buffer(raw)])
        return pc.cast(found, pa.decimal128(*c.digits)) if kind == "NUMERIC" else found
    code = "<f8" if isinstance(c.spark_type, T.DoubleType) else f"<i{wire.wire_width(c)}"
    numbers = np.zeros(len(nulls), code)
    numbers[valid] = _numbers(data, at, code)
    if kind == "DATE":
        return pa.array((numbers + EPOCH_2000_DAYS).astype(np.int32), mask=nulls).cast(pa.date32())
    if kind in ("TIMESTAMP", "TIMESTAMPTZ"):
        zone = "UTC" if kind == "TIMESTAMPTZ" else None
        return pa.array(numbers + EPOCH_2000_MICROS, mask=nulls).cast(pa.timestamp("us", zone))
    if kind == "BOOLEAN":
        return pa.array(numbers != 0, mask=nulls)
    return pa.array(numbers, mask=nulls)


def decoded(data: np.ndarray, starts: np.ndarray, columns, wanted: list[str]) -> pa.RecordBatch:
    """The wanted columns of rows that start at some places."""
    flags = (len(columns) + 7) // 8
    bits = np.unpackbits(data[(starts + 4)[:, None] + np.arange(flags)], axis=1)[:, : len(columns)].astype(bool)
    cursor = starts + 4 + flags
    found = {}
    last = max((i for i, c in enumerate(columns) if c.name in wanted), default=-1)
    for i, c in enumerate(columns[: last + 1]):
        nulls = bits[:, i]
        valid = ~nulls
        at = cursor[valid]
        width = wire.wire_width(c)
        if width == wire.VARIABLE:
            lengths = _numbers(data, at, "<i4").astype(np.int64)
            at = at + 4
            cursor[valid] += 4 + lengths
        else:
            lengths = np.full(len(at), width, np.int64)
            cursor[valid] += width
        if c.name in wanted:
            found[c.name] = _value(c, data, at, lengths, nulls)
    if not wanted:  # rows are counted only
        raise ValueError("no column is wanted")
    return pa.RecordBatch.from_arrays([found[name] for name in wanted], wanted)


def _walked(data: np.ndarray, at: int, flags: int) -> np.ndarray:
    """Sizes of the rows of a file without a list of them."""
    raw, sizes = data.tobytes(), []
    while at < len(raw):
        sizes.append(4 + flags + int.from_bytes(raw[at : at + 4], "little"))
        at += sizes[-1]
    if at != len(raw):
        raise ValueError("a file ends within a row")
    return np.array(sizes, np.int64)


class NativeReader(DataSourceReader):
    def __init__(self, path: str, columns, wanted: list[str], manifests: list[dict]):
        self.path, self.columns, self.wanted, self.manifests = path, columns, wanted, manifests

    def partitions(self):
        return ranges_of(self.manifests)

    def read(self, part):
        from sluice.sources.native import filesystem, header_size

        if part is None:  # a dataset without files
            return
        fs, root = filesystem(self.path)
        flags = (len(self.columns) + 7) // 8
        with fs.open_input_file(posixpath.join(root, part.file)) as file:
            file.seek(part.start)
            data = np.frombuffer(file.read(part.end - part.start), np.uint8)
        if len(data) != part.end - part.start:
            raise ValueError(f"file {part.file} is shorter than its manifest says")
        if part.sizes:
            with fs.open_input_file(posixpath.join(root, part.sizes)) as file:
                file.seek(4 * part.first_row)
                sizes = np.frombuffer(file.read(4 * part.rows), "<u4").astype(np.int64)
            begin = 0
        else:
            begin = header_size(len(self.columns))
            sizes = _walked(data, begin, flags)
        ends = begin + np.cumsum(sizes)
        starts = ends - sizes
        if len(sizes) != part.rows or len(ends) and ends[-1] != len(data):
            raise ValueError(f"file {part.file} does not hold the rows that its manifest says")
        at = 0
        while at < len(starts):
            upto = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES, side="right")))
            yield decoded(data, starts[at:upto], self.columns, self.wanted)
            at = upto


def dataset_columns(manifests: list[dict]) -> list[TargetColumn]:
    """Columns of a dataset, which all its runs must share."""
    kinds = {json.dumps(m.get("columns")) for m in manifests}
    if len(kinds) != 1 or kinds == {"null"}:
        raise LoadPlanError("the runs of a native dataset must name their columns, and the same ones" if manifests else "no run was published")
    return [TargetColumn(*c) for c in manifests[0]["columns"]]


def read_native(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Rows of a native dataset as values of its columns' Spark types; only the named ``columns`` are decoded.

    CHAR and fixed BINARY values come back padded; TIME, TIMETZ and INTERVAL as the integers that the format holds.
    """
    from sluice.sources.native import FORMAT, NativeSink, qualified, read_manifests

    spark.dataSource.register(NativeSink)
    path = qualified(spark, path)
    reader = spark.read.format(FORMAT).option("path", path)
    if columns is not None:
        kinds = {c.name: c for c in dataset_columns(read_manifests(path))}
        missing = [name for name in columns if name not in kinds]
        if missing or not columns:
            raise LoadPlanError(f"the dataset has no columns {', '.join(missing)}" if missing else "no column is wanted")
        reader = reader.schema(schema_of([kinds[name] for name in columns]))
    return reader.load()
