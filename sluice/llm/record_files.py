"""Token sequences in length-delimited binary records, with an index of offsets for reads in any order.

A data file is a row of records. A record is its payload's length (unsigned, 8 bytes), the masked checksum of
those 8 bytes (4 bytes), the payload, and the payload's masked checksum (4 bytes); all numbers are
little-endian. A payload is a flag byte (1: ids of 2 bytes, 2: document id given), the document id (8 bytes) and the
token ids (2 or 4 bytes each). A file's index has 16 bytes for every record, its offset and the number of ids before it in
the file, and 16 more for the file's end. Checksums are CRC-32 (zlib), masked by a rotation and a constant, so
that a checksum of stored checksums isn't trivial.

The manifest, a Parquet table written by a Spark job, lists the files of the tasks that counted; readers trust it alone,
so files of lost or repeated attempts don't matter.
"""

from __future__ import annotations

import struct
import zlib
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sluice.llm.common import kept, pieces, texts
from sluice.llm.token_units import UNITS, Encoder, Memo, words
from sluice.sources.native import filesystem, qualified
from sluice.sources.workspace import write_table

SHORT, HAS_ID = 1, 2
#: Records that a task of the reader takes at a time.
RANGE = 4096
#: Bytes a reader or writer holds of a file.
BUFFER = 1 << 22

MANIFEST = "part int, file string, records bigint, tokens bigint, bytes bigint"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def payload_of(doc_id: int | None, ids: np.ndarray) -> bytes:
    short = not len(ids) or int(ids.max()) < 1 << 16
    flag = (SHORT if short else 0) | (0 if doc_id is None else HAS_ID)
    return struct.pack("<Bq", flag, doc_id or 0) + ids.astype("<u2" if short else "<u4").tobytes()


def parsed(payload: bytes) -> tuple[int | None, np.ndarray]:
    flag, doc_id = struct.unpack_from("<Bq", payload)
    ids = np.frombuffer(payload, "<u2" if flag & SHORT else "<u4", offset=9).astype("<u4")
    return (doc_id if flag & HAS_ID else None), ids


def unframed(data: bytes, at: int) -> tuple[bytes, int]:
    """The payload of the record at a place, and the next record's place; raises if a checksum is wrong."""
    (length,) = struct.unpack_from("<Q", data, at)
    if struct.unpack_from("<I", data, at + 8)[0] != masked(data[at : at + 8]):
        raise ValueError(f"the length of the record at {at} is damaged")
    payload = data[at + 12 : at + 12 + length]
    if len(payload) != length or struct.unpack_from("<I", data, at + 12 + length)[0] != masked(payload):
        raise ValueError(f"the record at {at} is damaged")
    return payload, at + 16 + length


class RecordWriter:
    """One data file and its index."""

    def __init__(self, path: str):
        fs, self.path = filesystem(path)
        self.data = fs.open_output_stream(self.path, buffer_size=BUFFER)
        self.index = fs.open_output_stream(self.path + ".index", buffer_size=1 << 16)
        self.records = self.tokens = self.bytes = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.index.write(struct.pack("<QQ", self.bytes, self.tokens))
        record = framed(payload_of(doc_id, ids))
        self.data.write(record)
        self.records += 1
        self.tokens += len(ids)
        self.bytes += len(record)

    def close(self) -> None:
        self.index.write(struct.pack("<QQ", self.bytes, self.tokens))
        self.data.close()
        self.index.close()


def write_sequences(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, files: int | None = None, split=words) -> DataFrame:
    """Encode every text, append ``end_id`` and write the sequences in ascending doc_id order; returns the manifest.

    Texts are range-partitioned by doc_id, then encoded and written, one file per task, so ids are never shuffled. Equal ids are
    ordered by a hash of their text and may be split between files; null ids come first and null texts count as
    empty, which leaves the end id alone. An empty table gives an empty manifest. Other columns don't matter.
    ``folder`` must be on storage that all executors share.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    with open(tokenizer_file, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)

    def write(batches):
        spec = shared.value

        memo, end = kept(("sequences", hash(spec)), lambda: Memo(Encoder(spec), UNITS)), np.array([end_id], "<u4").tobytes()
        name, out = f"part-{TaskContext.get().partitionId():06d}-{uuid4().hex}.rec", None
        for piece in pieces(batches):
            out = out or RecordWriter(f"{folder}/{name}")
            units = [split(text) for text in texts(piece.column("text"))]
            known = memo.know(units)
            for doc_id, own in zip(piece.column("doc_id").to_pylist(), units):
                out.add(doc_id, np.frombuffer(b"".join([*map(known.__getitem__, own), end]), "<u4"))
        if out:
            out.close()
            yield pa.RecordBatch.from_pylist([{
                "part": TaskContext.get().partitionId(), "file": name, "records": out.records, "tokens": out.tokens,
                "bytes": out.bytes}], pa.schema([("part", pa.int32()), ("file", pa.string()), ("records", pa.int64()),
                                                 ("tokens", pa.int64()), ("bytes", pa.int64())]))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return write_table(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST), f"{folder}/manifest")


def read_sequences(spark: SparkSession, folder: str, each=None, schema: str = "ids array<bigint>", seed: int | None = None) -> DataFrame:
    """doc_id, start, n_tokens and what ``each(ids)`` gives (a tuple that fits ``schema``) for every record of a folder.

    ``start`` is the number of ids before the record in the whole folder. The index lets each task read a range
    of records of a file; with a ``seed`` the ranges are dealt out at random, for reads in shuffled order.
    Checksums are verified.
    """
    folder = qualified(spark, folder)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("file", "records", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    # apart from the sum, which would count a file once for each of its ranges
    ranges = files.select("file", "before", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("records") - 1, F.lit(RANGE).cast("bigint"))).alias("first"))
    deal = F.xxhash64("file", "first") if seed is None else F.xxhash64("file", "first", F.lit(seed))
    ranges = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), deal)
    if seed is not None:
        ranges = ranges.sortWithinPartitions(deal)
    each = each or (lambda ids: (ids.tolist(),))
    result = spark.createDataFrame([], f"doc_id bigint, start bigint, n_tokens bigint, {schema}").schema

    def read(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(result)
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = filesystem(f"{folder}/{row['file']}")
                with fs.open_input_file(path + ".index") as index:
                    index.seek(16 * row["first"])
                    places = np.frombuffer(index.read(16 * (RANGE + 1)), "<u8").reshape(-1, 2)
                with fs.open_input_file(path) as data:
                    at = 0
                    while at < len(places) - 1:  # as many records as fit the buffer, one at least
                        start = int(places[at, 0])
                        upto = max(at + 1, int(np.searchsorted(places[:, 0], start + BUFFER, "right")) - 1)
                        data.seek(start)
                        read = data.read(int(places[upto, 0]) - start)
                        rows, place = [], 0
                        for k in range(at, upto):
                            payload, place = unframed(read, place)
                            doc_id, ids = parsed(payload)
                            rows.append((doc_id, row["before"] + int(places[k, 1]), len(ids), *each(ids)))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(column, kind) for column, kind in zip(zip(*rows), arrow.types)], arrow.names)
                        at = upto

    return ranges.mapInArrow(read, result)
