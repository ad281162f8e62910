"""Which column's values another can hold, and bringing an existing table to the columns of a load."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

from sluice.errors import LoadPlanError
from sluice.plans.spec import BINARY_TYPES, FLOAT_TYPES, INTEGER_TYPES, INTERVAL_TYPES, TEXT_TYPES, TargetColumn
from sluice.sources.target import DECLARED, columns_from_table, declaration

ADD, KEEP, REFUSE = "add", "keep", "refuse"


@dataclass(frozen=True)
class Step:
    """What happens to one column: it is added, kept as the table has it, or refused."""

    kind: str
    column: TargetColumn
    text: str


def fits(c: TargetColumn, live: TargetColumn) -> bool:
    """Whether every value that conforms to ``c`` can be stored in a table's column as it is: the same family, no narrower."""
    kind, other = c.type_name, live.type_name
    if kind in INTEGER_TYPES:
        return other in INTEGER_TYPES and live.width >= c.width
    if kind in FLOAT_TYPES:
        return other in FLOAT_TYPES
    if kind == "NUMERIC":
        (digits, scale), (most, room) = c.digits, live.digits if other == "NUMERIC" else (0, 0)
        return room >= scale and most - room >= digits - scale
    if kind in TEXT_TYPES or kind in BINARY_TYPES:
        family = TEXT_TYPES if kind in TEXT_TYPES else BINARY_TYPES
        fixed = other == "CHAR" or live.fixed
        return other in family and (live.length is None or c.length is not None and c.length <= live.length) and not (
            fixed and (kind != other or c.length != live.length))
    if kind in INTERVAL_TYPES or kind in ("TIME", "TIMETZ"):  # these travel as integers
        same = other in INTERVAL_TYPES if kind in INTERVAL_TYPES else other == kind
        return same or other in INTEGER_TYPES and live.width == 8
    return kind == other


def evolution(spark: SparkSession, table: str, columns) -> list[Step]:
    """Steps that bring a table to these columns, in their order. Runs no job and changes nothing.

    Columns are added at the end. One that holds all values is kept, however much wider it is; every other difference is refused:
    it would narrow the table, and Spark's own catalog doesn't widen columns, not even VARCHAR ones. Columns of the table that
    aren't listed stay.
    """
    live = {c.name.lower(): c for c in columns_from_table(spark, table)}
    steps = []
    for c in columns:
        held = live.get(c.name.lower())
        if held is None:
            steps.append(Step(ADD, c, f"column {c.name} {c.type_text} is added"))
        elif fits(c, held):
            steps.append(Step(KEEP, c, f"column {held.name} stays {held.type_text}"))
        else:
            steps.append(Step(REFUSE, c, f"column {held.name}: {held.type_text} cannot become {c.type_text}"))
    return steps


def evolve_target(spark: SparkSession, table: str, columns) -> list[Step]:
    """Apply ``evolution`` through ALTER TABLE, or raise before anything is changed. Old rows have NULL in added columns.

    Every step is found from the table as it is, so a call that was cut short is completed by the next one.
    """
    steps = evolution(spark, table, columns)
    refused = [step.text for step in steps if step.kind == REFUSE]
    if refused:
        raise LoadPlanError(f"table {table}: " + "; ".join(refused))
    added = [step.column for step in steps if step.kind == ADD]
    if added:
        _declare(spark, table, added)
        listed = ", ".join(f"{_quoted(c.name)} {c.table_type.simpleString()}" for c in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    return steps


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _declare(spark: SparkSession, table: str, columns) -> None:
    """Keep declared types as table properties: ALTER TABLE can't give a column's metadata."""
    listed = ", ".join(f"{_text(f'{DECLARED}.{c.name.lower()}')} = {_text(json.dumps(declaration(c)))}" for c in columns)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
