"""Rows in the partitions that they name: each id's rows go to a partition of its own, a hot id's to several."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sluice.errors import LoadPlanError
from sluice.operators.mapping import column
from sluice.plans.load import steady

#: Ids at most: their counts go through the driver, and their partitions into the plan.
IDS = 100_000


@dataclass(frozen=True)
class Addressed:
    """Rows by partition; id i has the partitions from ``firsts[i]``, ``parts[i]`` of them."""

    rows: DataFrame
    firsts: tuple[int, ...]
    parts: tuple[int, ...]


def addressed(df: DataFrame, id_field: str, ids: int, most: int | None = None) -> Addressed:
    """Rows whose ``id_field`` is i, from 0 up to ``ids`` - 1, in partitions that hold no other id.

    With ``most``, ids with more rows than that are split into as many partitions as it takes, in about even shares, copies of one
    row too; that takes a count per id beforehand. A row's share depends on its place among its task's rows, which are sorted by
    content first where a task that is run again might see them in another order. Every id has a partition, if an empty one. A NULL
    id, or one outside the range, fails the job.
    """
    if not 0 < ids <= IDS:
        raise LoadPlanError(f"rows can be sent to 1 to {IDS} ids, not {ids}")
    if most is not None and most < 1:
        raise LoadPlanError("a partition needs room for at least one row")
    key = column(id_field).cast("bigint")
    wrong = F.raise_error(F.concat(F.lit(f"field {id_field} names no partition: "), F.coalesce(key.cast("string"), F.lit("NULL")))).cast("int")
    valid = F.when(key.between(0, ids - 1), key.cast("int")).otherwise(wrong)
    parts = [1] * ids
    if most is not None:
        for row in df.where(key.between(0, ids - 1)).groupBy(key.alias("id")).agg(F.count(F.lit(1)).alias("rows")).collect():
            parts[row["id"]] = -(-row["rows"] // most)
    firsts = [0]
    for n in parts[:-1]:
        firsts.append(firsts[-1] + n)
    if max(parts) == 1:
        place, rows = valid, df
    else:
        rows = steady(df)
        at = valid + 1
        share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.element_at(F.lit(parts), at)).cast("int")
        place = F.element_at(F.lit(firsts), at) + share
    return Addressed(rows.repartitionById(firsts[-1] + parts[-1], place), tuple(firsts), tuple(parts))
