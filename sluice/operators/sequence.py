"""Dense sequence numbers without a global window.

Rows are written once to the shared folder together with the partition they were in and their place
in it. Counting rows per partition gives every partition its first number. Because both facts are read
back from the written table, a lost executor or another partition layout cannot change them, and since
partitions are not key groups, no key, however frequent, ends up in one task.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Window, functions as F

from sluice.errors import LoadPlanError
from sluice.operators.mapping import column
from sluice.plans.load import cluster
from sluice.sources.workspace import new_folder, scratch, write_table

# Defaults of the sequence step.
START, STEP = 1, 1

_PARTITION = "__load_partition"
_PLACE = "__load_place"
_FIRST = "__load_first"
_PLACE_BITS = 33  # monotonically_increasing_id keeps a row's place in its partition in the low 33 bits


def add_sequence(df: DataFrame, name: str, start: int = START, step: int = STEP, maximum: int | None = None,
                 order_by=(), partitions: int | None = None, folder: str | None = None) -> DataFrame:
    """Number the rows ``start, start + step, ...`` in arrival order, or in the order of some columns.

    Rows that tie in those columns get their numbers in no particular order. Raises before any row is returned if the last
    number would pass ``maximum``. The result reads a copy of the rows, which goes to ``folder`` or below the shared
    folder and stays there; ``numbered`` removes it.
    """
    if step == 0:
        raise LoadPlanError("a sequence needs a step other than 0")
    if name in df.columns:
        raise LoadPlanError(f"field {name} exists already")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    folder = folder or new_folder(df.sparkSession, "sequence")
    written = write_table(
        cluster(df, order_by, partitions)
        .withColumn(_PARTITION, F.spark_partition_id())
        .withColumn(_PLACE, place),
        f"{folder}/rows",
    )

    # one small row per written partition, about a million for the largest jobs: that bounds this window and the broadcast
    before = Window.orderBy(_PARTITION).rowsBetween(Window.unboundedPreceding, -1)
    counts = write_table(written.groupBy(_PARTITION).agg(F.count(F.lit(1)).alias("rows")), f"{folder}/counts")
    firsts = counts.select(_PARTITION, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(_FIRST), "rows")

    if maximum is not None:
        total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]
        last = start + (total - 1) * step
        if total and last > maximum:
            raise LoadPlanError(f"{total} rows would take the sequence to {last}, past its maximum {maximum}")

    number = F.lit(start).cast("bigint") + (F.col(_FIRST) + F.col(_PLACE)) * F.lit(step).cast("bigint")
    return (
        written.join(F.broadcast(firsts.drop("rows")), _PARTITION)
        .select(*[column(c) for c in df.columns], number.alias(name))
    )


@contextmanager
def numbered(df: DataFrame, name: str, **settings):
    """``add_sequence`` for rows that are read up before the block ends, which removes their copy."""
    with scratch(df.sparkSession, "sequence") as folder:
        yield add_sequence(df, name, folder=folder, **settings)
