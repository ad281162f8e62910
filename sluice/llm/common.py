"""Small helpers that the operators share: objects kept by a worker, Arrow pieces, integer hashes."""

from __future__ import annotations

import ctypes
import gc
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

#: Rows of a batch that are worked on at a time, so that very long texts don't add up.
PIECE_ROWS = 256


def kept(key, build):
    """The object of ``key`` in this Python worker, built at its first use.

    Module variables don't live on between tasks where the package is shipped by value; this place does.
    Only the newest object stays, whatever its kind, so that a worker that serves one operator after the other doesn't gather theirs.
    The system gets back what the last one took, and what was only needed for building.
    """
    store = sys.modules.setdefault("_sluice_llm_kept", types.ModuleType("_sluice_llm_kept")).__dict__
    held = store.get("newest")
    if held is None or held[0] != key:
        if store.pop("newest", None) is not None:  # gone before the next is built
            held = None
            give_back()
        held = store["newest"] = (key, build())
        give_back()
    return held[1]


def give_back() -> None:
    """Return freed memory to the system. A worker outlives its tasks, and its free memory counts beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries than GNU's have none
    if trim:
        trim(0)


def pieces(batches, rows: int = PIECE_ROWS):
    """Arrow batches cut into pieces of at most ``rows`` rows; empty ones are left out."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts(column: pa.Array) -> list[str]:
    """Python texts of a column; null counts as empty."""
    return pc.fill_null(column, "").to_pylist()


def utf8_length(column: pa.Array) -> pa.Array:
    return pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())


def id_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))


def with_id(docs: DataFrame, *fields: tuple) -> T.StructType:
    """A schema of doc_id, as ``docs`` has it, and (name, type) fields."""
    return T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]
                        + [T.StructField(name, kind) for name, kind in fields])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of unsigned integers (the public splitmix64 finaliser's constants)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
