"""Byte layout of the native row format.

Spark prepares one plain column per target column (``wire_columns``); Arrow batches of those are then
joined into row bytes with vectorized Arrow and NumPy operations. All integers are little-endian.

    file    signature, int32 header length, int16 version, one zero byte, int16 columns, int32 width each
    row     int32 size of the values, NULL bitmap, values that are not NULL, in column order
    value   fixed width, or int32 length and bytes where the width is -1
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from sluice.errors import LoadPlanError
from sluice.functions import epoch
from sluice.plans.spec import INTEGER_TYPES, TargetColumn

# Fixed values of the format.
SIGNATURE = b"NATIVE\n\xff\r\n\x00"
VERSION = 1
VARIABLE = -1
MOST_COLUMNS = 2**15 - 1

MOST_BATCH_BYTES = 1 << 28  # larger Arrow batches are encoded in slices


def is_variable(c: TargetColumn) -> bool:
    return c.type_name in ("VARCHAR", "VARBINARY", "NUMERIC") or c.type_name == "BINARY" and not c.fixed


def wire_width(c: TargetColumn) -> int:
    """Width in bytes, or -1."""
    if is_variable(c):
        return VARIABLE
    if c.type_name in INTEGER_TYPES:
        return c.width
    if c.type_name in ("CHAR", "BINARY"):
        return c.length
    return 1 if c.type_name == "BOOLEAN" else 8


def file_header(widths: list[int]) -> bytes:
    n = len(widths)
    if n > MOST_COLUMNS:
        raise LoadPlanError(f"the native format holds {MOST_COLUMNS} columns, not {n}")
    return SIGNATURE + struct.pack(f"<ihbh{n}i", 5 + 4 * n, VERSION, 0, n, *widths)


def wire_value(value: Column, c: TargetColumn) -> Column:
    """Conformed value as the plain type that is put into bytes."""
    kind = c.type_name
    if kind == "DATE":
        return epoch.encode_date(value, c.spark_type)
    if kind == "TIMESTAMP":
        return epoch.encode_timestamp(value, c.spark_type, precision="micros")
    if kind == "TIMESTAMPTZ":
        return epoch.encode_timestamptz(value, c.spark_type, precision="micros")
    if kind == "NUMERIC":
        return numeric_text(value, c.digits[1])
    return value


def numeric_text(value: Column, scale: int) -> Column:
    """Digits of a DECIMAL, never in exponent form, whatever the session's ANSI setting."""
    text = value.cast("string")
    if scale <= 6:  # too few decimals for an exponent
        return text
    # an exponent only appears below 1e-6, where the digits before the point are a single zero
    sign = F.when(value < 0, F.lit("-0")).otherwise(F.lit("0"))
    small = F.concat(sign, F.trim(F.to_char(F.abs(value), F.lit("." + "0" * scale))))
    return F.when(F.contains(text, F.lit("E")), small).otherwise(text)


def _bytes_of(data: np.ndarray, valid: np.ndarray | None, width: int) -> pa.Array:
    """Binary array over fixed-width values; NULLs take no bytes."""
    n = len(data)
    raw = np.ascontiguousarray(data).view(np.uint8).reshape(n, width)
    if valid is None:
        offsets = np.arange(n + 1, dtype=np.int64) * width
    else:
        raw = raw[valid]
        offsets = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(valid * np.int64(width), out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw.ravel())])


def _plain(array) -> pa.Array:
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


def _encode_column(array: pa.Array, width: int) -> tuple[pa.Array, np.ndarray, np.ndarray | None]:
    """Bytes of one column, their size per row and the valid rows (None if all are)."""
    n = len(array)
    valid = None if array.null_count == 0 else np.asarray(pc.is_valid(array).to_numpy(zero_copy_only=False))
    kind = array.type
    if pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) \
            or pa.types.is_large_binary(kind):
        data = array.cast(pa.large_string()).cast(pa.large_binary()) if pa.types.is_string(kind) \
            else array.cast(pa.large_binary())
        data = pc.fill_null(data, b"")
        sizes = pc.binary_length(data).to_numpy(zero_copy_only=False).astype(np.int64)
        if width == VARIABLE:
            prefix = _bytes_of(sizes.astype("<i4"), valid, 4)
            data = pc.binary_join_element_wise(prefix, data, pa.scalar(b"", pa.large_binary()))
            sizes = sizes + (4 if valid is None else valid * 4)
        return data, sizes, valid
    if pa.types.is_boolean(kind):
        numbers = pc.fill_null(array, False).cast(pa.uint8()).to_numpy(zero_copy_only=False)
    else:
        code = "<f8" if pa.types.is_floating(kind) else f"<i{width}"
        numbers = pc.fill_null(array, 0).to_numpy(zero_copy_only=False).astype(code, copy=False)
    sizes = np.full(n, width, dtype=np.int64) if valid is None else valid * np.int64(width)
    return _bytes_of(numbers, valid, width), sizes, valid


def encode_batch(batch: pa.RecordBatch, widths: list[int]) -> pa.Array:
    """Row bytes of a batch, one large-binary value per row."""
    n = batch.num_rows
    empty = pa.scalar(b"", pa.large_binary())
    parts, total = [], np.zeros(n, dtype=np.int64)
    nulls = np.zeros((n, len(widths)), dtype=bool)
    for i, width in enumerate(widths):
        data, sizes, valid = _encode_column(_plain(batch.column(i)), width)
        parts.append(data)
        total += sizes
        if valid is not None:
            nulls[:, i] = ~valid
    if n and total.max() > np.iinfo(np.int32).max:
        raise ValueError("a row is larger than the native format can hold")
    flags = np.packbits(nulls, axis=1)
    head = [_bytes_of(total.astype("<i4"), None, 4), _bytes_of(flags, None, flags.shape[1])]
    return pc.binary_join_element_wise(*head, *parts, empty)


def slices(batch: pa.RecordBatch):
    """The batch in pieces of bounded size; a single row is never split."""
    pieces = max(1, -(-batch.nbytes // MOST_BATCH_BYTES))
    rows = max(1, -(-batch.num_rows // pieces))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def joined_bytes(rows: pa.Array) -> memoryview:
    """All row bytes of an encoded batch, one after the other, without a copy."""
    _, offsets, data = rows.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[rows.offset:rows.offset + len(rows) + 1]
    return memoryview(data)[bounds[0]:bounds[-1]] if len(rows) else memoryview(b"")


def split_rows(data: bytes, flags: int) -> tuple[list[bytes], bytes]:
    """Whole rows at the start of some bytes, and what is left; ``flags`` is the number of bytes for NULL flags."""
    rows, at = [], 0
    while at + 4 <= len(data):
        end = at + 4 + flags + int.from_bytes(data[at : at + 4], "little")
        if end > len(data):
            break
        rows.append(data[at:end])
        at = end
    return rows, data[at:]
