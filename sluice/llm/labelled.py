"""Bounded samples of labelled documents, for classifiers that are fitted on the driver and applied to every text."""

from __future__ import annotations

import zlib
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluice.sources.workspace import scratch, write_table

#: Labelled rows that a classifier is fitted on, at most.
FITTED = 16_000
#: UTF-8 bytes of their texts, at most. Their features go to the driver, at most 12 bytes for each distinct word of a text.
FITTED_BYTES = 64 << 20
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder: such rows' labels are never learned from. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


@contextmanager
def sampled(docs: DataFrame, labels: DataFrame, label: str, most: int = FITTED, most_bytes: int = FITTED_BYTES):
    """text and y of at most ``most`` documents whose label may be learned, the first by a hash of their id.

    The sample's ids are broadcast: there are at most ``most``. Of an id with several labels the largest counts, of an id with
    several rows the greatest text (none if all are null), so repeated ids don't make the sample larger. Its texts have
    ``most_bytes`` together at most: those by which the sum would pass that are left out, whole. Rows come in the order of
    their ids, whatever the layout of the tables. They are read from a small table in the shared folder, which the block's end removes.
    """
    rank = F.xxhash64("doc_id", F.lit(label))
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = known.orderBy(rank, "doc_id").limit(most).groupBy("doc_id").agg(F.max("y").alias("y"))
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    found = found.groupBy("doc_id").agg(F.max("y").alias("y"), F.max("text").alias("text")).withColumn("rank", rank)
    with scratch(docs.sparkSession, "labelled") as folder:
        rows = write_table(found, folder)
        upto = Window.orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # over sizes alone
        sizes = rows.select("doc_id", "rank", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"))
        fitting = sizes.select("doc_id", F.sum("size").over(upto).alias("upto")).filter(F.col("upto") <= most_bytes).select("doc_id")
        yield rows.join(F.broadcast(fitting), "doc_id").orderBy("doc_id").select("text", "y")


def crc(word: bytes) -> int:
    return zlib.crc32(word)
