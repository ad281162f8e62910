"""Native files: layout, round trip, commit and abort."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.errors import LoadAborted, LoadPlanError
from sluice.functions import wire
from sluice.plans.load import load
from sluice.plans.spec import LoadSpec, TargetColumn as Col
from sluice.sources import native
from sluice.sources.native import NativeTarget, encode_rows, filesystem, published_bytes, read_manifests
from tests.native_reader import read_rows

ALL = (
    Col("i8", "INTEGER"), Col("i4", "INTEGER", width=4), Col("i2", "INTEGER", width=2), Col("i1", "INTEGER", width=1),
    Col("b", "BOOLEAN"), Col("f", "FLOAT"), Col("c", "CHAR", 5), Col("v", "VARCHAR", 20), Col("d", "DATE"), Col("t", "TIME"),
    Col("tz", "TIMETZ"), Col("ts", "TIMESTAMP"), Col("tsz", "TIMESTAMPTZ"), Col("iv", "INTERVAL"), Col("vb", "VARBINARY", 9),
    Col("fb", "BINARY", 4, fixed=True), Col("n", "NUMERIC", 20, 10),
)
KINDS = ("int int int int bool float text text int int int int int int bytes bytes text").split()
SCHEMA = ("i8 long, i4 long, i2 long, i1 long, b boolean, f double, c string, v string, d date, t timestamp_ntz, "
          "tz timestamp_ntz, ts timestamp_ntz, tsz timestamp_ntz, iv interval day to second, vb binary, fb binary, n decimal(20,10)")
MOMENT = datetime(2000, 1, 2, 0, 0, 1, 5999)
FULL = (-2, -3, -4, -5, True, -1.5, "äb", "schöne \\. Zeile\n", date(1999, 12, 31), MOMENT, MOMENT, MOMENT, MOMENT,
        timedelta(days=-1, microseconds=1), b"\x00\xff", b"\x01", Decimal("-0.0000001000"))
EXPECTED = (-2, -3, -4, -5, True, -1.5, "äb  ", "schöne \\. Zeile\n", -1, 1005000, (1005000 << 24) + 86400, 86401005000,
            86401005000, -86399999999, b"\x00\xff", b"\x01\x00\x00\x00", "-0.0000001000")


def parts(path):
    return sorted(Path(path).glob("part-*.bin"))


def read_all(path, kinds):
    return [row for p in parts(path) for row in read_rows(p.read_bytes(), kinds)]


def alternating(row):
    """The row with every other value missing, both ways, and with none."""
    return [tuple(v if i % 2 == k else None for i, v in enumerate(row)) for k in (0, 1)] + [(None,) * len(row)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_every_type_survives(spark, tmp_path, ansi):
    rows = [FULL] + alternating(FULL)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        report = load(df, LoadSpec(ALL), NativeTarget(str(tmp_path / "out"), ALL))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert report.rows_accepted == 4
    assert read_all(tmp_path / "out", KINDS) == [EXPECTED] + alternating(EXPECTED)


def test_many_rows_and_files(spark, tmp_path):
    columns = (Col("k", "INTEGER"), Col("s", "VARCHAR", 50))
    df = spark.range(0, 30000, 1, 3).select("id", F.repeat(F.lit("é"), (F.col("id") % 20).cast("int")))
    out = str(tmp_path / "out")
    load(df, LoadSpec(columns), NativeTarget(out, columns))
    assert len(parts(out)) == 3
    assert sorted(read_all(out, ["int", "text"])) == [(i, "é" * (i % 20)) for i in range(30000)]
    (manifest,) = read_manifests(out)
    assert manifest["rows"] == 30000
    assert manifest["bytes"] == sum(p.stat().st_size for p in parts(out))
    assert sorted(f["file"] for f in manifest["files"]) == [p.name for p in parts(out)]
    files, row_bytes = published_bytes(spark, out, 2).first()
    assert files == 3 and row_bytes == manifest["bytes"] - 3 * 28
    rows = encode_rows(df.toDF("k", "s"), columns).agg(F.sum(F.octet_length("row_bytes"))).first()[0]
    assert rows == row_bytes


def test_rows_are_not_split_between_batches(spark, tmp_path):
    columns = tuple(Col(f"c{i}", "VARCHAR", 19) for i in range(4))
    rows = [("n" * 19, "four", "seventh", "eight ok")] * 501
    out = str(tmp_path / "out")
    load(spark.createDataFrame(rows, "a string, b string, c string, d string"), LoadSpec(columns), NativeTarget(out, columns))
    assert read_all(out, ["text"] * 4) == rows


def test_append_and_overwrite(spark, tmp_path):
    columns = (Col("k", "INTEGER"),)
    out = str(tmp_path / "out")
    for mode, expected in (("append", [0, 1]), ("append", [0, 0, 1, 1]), ("overwrite", [0, 1])):
        load(spark.range(2), LoadSpec(columns), NativeTarget(out, columns, mode))
        assert sorted(r[0] for r in read_all(out, ["int"])) == expected
    assert len(read_manifests(out)) == 1


@pytest.mark.parametrize("repeat", range(4))
def test_abort_leaves_nothing(spark, tmp_path, repeat):
    columns = (Col("k", "INTEGER"),)
    out = tmp_path / "out"
    df = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") == 3999, "x").otherwise("1"))
    with pytest.raises(LoadAborted):
        load(df, LoadSpec(columns), NativeTarget(str(out), columns))
    assert read_manifests(str(out)) == [] and published_bytes(spark, str(out), 1).first()["files"] == 0


def test_no_rows_no_files(spark, tmp_path):
    columns = (Col("k", "INTEGER"),)
    report = load(spark.range(0), LoadSpec(columns), NativeTarget(str(tmp_path / "out"), columns))
    assert report.rows_read == 0
    assert parts(tmp_path / "out") == []
    assert read_manifests(str(tmp_path / "out"))[0]["rows"] == 0


def test_header_limits():
    assert wire.file_header([8, -1])[11:] == bytes([13, 0, 0, 0, 1, 0, 0, 2, 0, 8, 0, 0, 0, 255, 255, 255, 255])
    with pytest.raises(LoadPlanError):
        wire.file_header([8] * 2**15)


def test_sliced_and_chunked_batches(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"k": [1, None, 3, 4], "s": ["a", "bb", None, "dddd"]})
    whole = wire.encode_batch(batch, [8, -1]).to_pylist()
    assert wire.encode_batch(batch.slice(1, 2), [8, -1]).to_pylist() == whole[1:3]
    monkeypatch.setattr(wire, "MOST_BATCH_BYTES", 10)
    pieces = [wire.joined_bytes(wire.encode_batch(p, [8, -1])) for p in wire.slices(batch)]
    assert len(pieces) == 4 and b"".join(pieces) == b"".join(whole)
    assert len(wire.encode_batch(batch.slice(0, 0), [8, -1])) == 0


def test_local_paths():
    for path in ("/a/b", "/a/b/", "file:/a/b", "file:///a/b"):
        assert filesystem(path)[1] == "/a/b"


def attempted(writer, monkeypatch):
    def attempt(partition, number, batches):
        context = SimpleNamespace(partitionId=lambda: partition, taskAttemptId=lambda: number)
        monkeypatch.setattr(native, "TaskContext", SimpleNamespace(get=lambda: context))
        return writer.write(iter(batches))

    return attempt


BATCH = pa.RecordBatch.from_pydict({"k": [1, 2]})


def dies():
    yield BATCH
    raise OSError("executor lost")


def test_repeated_and_lost_attempts(tmp_path, monkeypatch):
    """Only the attempts the driver heard of are published; the files of others are never read, and removed."""
    out = tmp_path / "out"
    out.mkdir()
    writer = native.NativeWriter(str(out), "first", [8], overwrite=False)
    attempt = attempted(writer, monkeypatch)
    with pytest.raises(OSError):
        attempt(0, 1, dies())
    attempt(0, 2, [BATCH])  # finished, but its message never arrived
    messages = [attempt(0, 3, [BATCH]), attempt(1, 4, []), attempt(2, 5, [BATCH, BATCH])]
    assert read_manifests(str(out)) == []
    writer.commit(messages)
    assert sorted(read_all(out, ["int"])) == [(1,)] * 3 + [(2,)] * 3
    assert sorted(p.name[:4] for p in out.iterdir()) == ["mani", "part", "part"]

    second = native.NativeWriter(str(out), "second", [8], overwrite=True)
    message = attempted(second, monkeypatch)(0, 6, [BATCH])
    second.abort([message])
    attempted(second, monkeypatch)(1, 7, [BATCH])  # a task that was still running
    assert len(read_manifests(str(out))) == 1 and sum(m["rows"] for m in read_manifests(str(out))) == 6


def test_commit_that_fails_publishes_nothing(spark, tmp_path, monkeypatch):
    out = tmp_path / "out"
    out.mkdir()
    writer = native.NativeWriter(str(out), "run", [8], overwrite=False)
    message = attempted(writer, monkeypatch)(0, 1, [BATCH])

    class Failing:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def move(self, a, b):
            raise OSError("store is gone")

    with monkeypatch.context() as m:
        plain = native.filesystem
        m.setattr(native, "filesystem", lambda path: (Failing(plain(path)[0]), plain(path)[1]))
        with pytest.raises(OSError):
            writer.commit([message])
    assert read_manifests(str(out)) == [] and len(parts(out)) == 1
    writer.abort([message])
    assert parts(out) == []


def test_run_that_is_published_again(tmp_path, monkeypatch):
    out = tmp_path / "out"
    out.mkdir()
    for number in (1, 2):
        writer = native.NativeWriter(str(out), "batch0", [8], overwrite=False)
        writer.commit([attempted(writer, monkeypatch)(0, number, [BATCH] * number)])
    assert sum(m["rows"] for m in read_manifests(str(out))) == 4 and len(parts(out)) == 1


def test_schemes(spark, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(native.pafs, "FileSystem", SimpleNamespace(from_uri=lambda uri: (uri, "bucket/a/b")))
        assert filesystem("s3a://bucket/a/b")[0] == "s3://bucket/a/b"
    for path in ("wasbs://c@a/b", "dbfs:/a"):
        with pytest.raises(LoadPlanError, match="cannot be written"):
            load(spark.range(1), LoadSpec((Col("k", "INTEGER"),)), NativeTarget(path, (Col("k", "INTEGER"),)))


def test_rows_are_read_back(spark, tmp_path, monkeypatch):
    columns = (Col("k", "INTEGER"), Col("s", "VARCHAR", 50))
    df = spark.range(0, 5000, 1, 3).select("id", F.repeat(F.lit("é"), (F.col("id") % 20).cast("int")))
    out = str(tmp_path / "out")
    load(df, LoadSpec(columns), NativeTarget(out, columns))
    monkeypatch.setattr(native, "READ_BYTES", 1000)
    found = native.published_rows(spark, out, 2).select("row_bytes").collect()
    assert sorted(map(bytes, (r[0] for r in found))) == sorted(
        bytes(r[0]) for r in encode_rows(df.toDF("k", "s"), columns).select("row_bytes").collect())


def test_plain_paths_follow_the_default_file_system(spark):
    assert filesystem(native.qualified(spark, "/a/b"))[1] == "/a/b"
    assert native.qualified(spark, "hdfs://h/a") == "hdfs://h/a"
    assert filesystem("file:///a/b")[1] == "/a/b"
