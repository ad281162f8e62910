"""Frequent units of all documents, counted where the texts are."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.common import pieces, texts
from sluice.sources.workspace import scratch, write_table

#: A unit is frequent from this share of all units on, so there are at most 1 / SHARE of them, whatever the input.
SHARE = 4e-6
#: Units that a task counts at a time; rare ones are forgotten beyond it, which only costs speed later.
COUNTED = 400_000


def frequent_units(docs: DataFrame, split, share: float = SHARE) -> list[str]:
    """Units with about ``share`` of all occurrences or more, most frequent first; at most 1 / ``share``.

    Every text is counted in full, but a task forgets its rarest units when it holds more than ``COUNTED``, and hands on
    those above half the share among its own: what is shuffled is a bounded summary of each task and never the texts'
    units. Counts are therefore lower bounds, and a unit near the share may be left out. The result only steers speed.
    Null texts count as empty; without any unit the list is empty.
    """

    def count(batches):
        counts: Counter = Counter()
        total = 0
        for piece in pieces(batches):
            for text in texts(piece.column(0)):
                units = split(text)
                total += len(units)
                counts.update(units)
            floor = 0
            while len(counts) > COUNTED // (2 if floor else 1):
                floor += 1
                counts = Counter({unit: n for unit, n in counts.items() if n > floor})
        least = total * share / 2
        found = [(unit, n) for unit, n in counts.items() if n >= least]
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *(unit for unit, _ in found)], pa.string()),
             pa.array([total, *(n for _, n in found)], pa.int64())], ["unit", "n"])

    spark = docs.sparkSession
    with scratch(spark, "frequent") as folder:
        counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "unit string, n bigint")
        counted = write_table(counted, folder)
        total = counted.filter(F.col("unit").isNull()).agg(F.sum("n")).first()[0] or 0  # rows without a unit hold totals
        rows = (
            counted.filter(F.col("unit").isNotNull()).groupBy("unit").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= share * total).collect()
        )
    return [row.unit for row in sorted(rows, key=lambda row: (-row.n, row.unit))]
