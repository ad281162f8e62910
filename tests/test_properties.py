"""Random values against plain Python."""

import random
import re
import struct
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from sluice.functions import conform as C, wire
from sluice.plans.spec import TargetColumn

TEXT = T.StringType()
SPACE = "[ \\t\\n\\r\\f\\x0b]*"
INTEGER = re.compile(SPACE + r"[+-]?[0-9]+" + SPACE)
NUMBER = re.compile(SPACE + r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?" + SPACE)


def random_texts(rng, n):
    texts = []
    for _ in range(n):
        digits = "".join(rng.choice("0123456789") for _ in range(rng.choice([0, 1, 2, 5, 18, 19, 20, 38, 39])))
        point = rng.choice(["", "", ".", "." + "".join(rng.choice("0123456789") for _ in range(rng.randint(0, 6)))])
        tail = rng.choice(["", "", "", "e2", "E-1", "e", "x", "d", " ", "\t", " 1"])
        texts.append(rng.choice(["", "", "-", "+", "  ", "--", "0x"]) + digits + point + tail)
    return texts + ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809"]


def as_integer(text):
    if not INTEGER.fullmatch(text):
        return None
    value = int(text)
    return value if -2**63 <= value < 2**63 else None


def as_numeric(text, digits, scale):
    if not NUMBER.fullmatch(text):
        return None
    with localcontext() as context:
        context.prec = 200
        value = Decimal(text.strip()).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)
    return value if abs(value) < Decimal(10) ** (digits - scale) else None


def test_text_to_numbers(spark):
    texts = random_texts(random.Random(5), 4000)
    value = F.col("t")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", C.to_integer(value, TEXT).alias("i"), C.to_float(value, TEXT).alias("f"),
        C.to_numeric(value, TEXT, 12, 3).alias("n"), C.to_numeric(value, TEXT, 38, 0).alias("w"),
    ).collect()
    assert sum(r["i"] is not None for r in rows) > 300 < sum(r["i"] is None for r in rows)
    for r in rows:
        t = r["t"]
        assert r["i"] == as_integer(t), t
        assert r["f"] == (float(t) if NUMBER.fullmatch(t) else None), t
        assert r["n"] == as_numeric(t, 12, 3), t
        if not re.search("[eE.]", t):
            assert r["w"] == as_numeric(t, 38, 0), t


@pytest.mark.parametrize("digits, scale", [(5, 2), (9, 0), (18, 4), (38, 10)])
def test_numbers_to_numeric(spark, digits, scale):
    rng = random.Random(digits)
    longs = [rng.randint(-2**63, 2**63 - 1) >> rng.randint(0, 62) for _ in range(1000)]
    decimals = [Decimal(rng.randint(-10**30, 10**30) // 10 ** rng.randint(0, 29)).scaleb(-6) for _ in range(1000)]
    df = spark.createDataFrame(list(zip(longs, decimals)), "l long, d decimal(38,6)")
    for r in df.select(
        "l", "d", C.to_numeric(F.col("l"), T.LongType(), digits, scale).alias("nl"),
        C.to_numeric(F.col("d"), T.DecimalType(38, 6), digits, scale).alias("nd"),
    ).collect():
        assert r["nl"] == as_numeric(str(r["l"]), digits, scale)
        assert r["nd"] == as_numeric(f"{r['d']:f}", digits, scale)


def test_doubles_to_integers(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-2, 19) for _ in range(3000)] + [i / 2 for i in range(-20, 21)]
    for v, i in spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", C.to_integer(F.col("v"), T.DoubleType())
    ).collect():
        exact = int((Decimal(v) + Decimal("0.5")).to_integral_value("ROUND_FLOOR"))
        assert i == (exact if -2**63 <= exact < 2**63 else None), v


def plain_row(values, columns):
    flags, data = 0, b""
    for i, (v, c) in enumerate(zip(values, columns)):
        if v is None:
            flags |= 1 << (len(columns) + -len(columns) % 8 - 1 - i)
        elif isinstance(v, bool):
            data += bytes([v])
        elif isinstance(v, int):
            data += v.to_bytes(wire.wire_width(c), "little", signed=True)
        elif isinstance(v, float):
            data += struct.pack("<d", v)
        else:
            raw = v.encode() if isinstance(v, str) else v
            data += struct.pack("<i", len(raw)) + raw
    return struct.pack("<i", len(data)) + flags.to_bytes((len(columns) + 7) // 8, "big") + data


COLUMNS = (
    TargetColumn("a", "INTEGER"), TargetColumn("b", "INTEGER", width=1), TargetColumn("c", "FLOAT"), TargetColumn("d", "BOOLEAN"),
    TargetColumn("e", "VARCHAR"), TargetColumn("f", "VARBINARY"), TargetColumn("g", "INTEGER", width=4),
    TargetColumn("h", "INTEGER", width=2), TargetColumn("i", "NUMERIC"),
)
ARROW = (pa.int64(), pa.int8(), pa.float64(), pa.bool_(), pa.string(), pa.binary(), pa.int32(), pa.int16(), pa.string())
ROW = st.tuples(*[st.none() | s for s in (
    st.integers(-2**63, 2**63 - 1), st.integers(-128, 127), st.floats(allow_nan=False), st.booleans(), st.text(max_size=20),
    st.binary(max_size=20), st.integers(-2**31, 2**31 - 1), st.integers(-2**15, 2**15 - 1), st.text("0123456789.-", max_size=9),
)])


@settings(max_examples=200, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=20), st.integers(0, 5))
def test_row_bytes(rows, skip):
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), ARROW)]
    batch = pa.RecordBatch.from_arrays(arrays, [c.name for c in COLUMNS]).slice(skip)
    encoded = wire.encode_batch(batch, [wire.wire_width(c) for c in COLUMNS])
    expected = [plain_row(r, COLUMNS) for r in rows[skip:]]
    assert encoded.to_pylist() == expected
    assert bytes(wire.joined_bytes(encoded)) == b"".join(expected)
