"""Accepting and rejecting rows.

A row is taken or rejected as a whole, and the first failing column in target order gives the reason.
Conversions are planned once, in one projection; the checks of the next projection only look whether
a conversion came out NULL. Everything here is a narrow transformation: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sluice.errors import LoadPlanError
from sluice.functions import conform as C
from sluice.operators.mapping import MappedField, column, resolve_mapping
from sluice.plans.spec import LoadSpec

PREFIX = "__load_"
REJECT_INDEX = PREFIX + "reject"  # position of the first failing column, NULL for good rows
SEPARATOR = " | "
NULL_TEXT = "null"


def _loaded_name(i: int) -> str:
    return f"{PREFIX}{i}"


def null_flags(columns: list[Column]) -> Column:
    """Bitmap of NULL columns: one bit each, the first column in the top bit of the first byte."""
    parts = []
    for start in range(0, len(columns), 8):
        bits = [F.when(c.isNull(), 1 << (7 - i)).otherwise(0) for i, c in enumerate(columns[start:start + 8])]
        value = sum(bits[1:], bits[0])
        parts.append(F.lpad(F.hex(value), 2, "0"))
    return F.unhex(F.concat(*parts)) if parts else F.lit(b"")


def show_value(value: Column, source_type: T.DataType, zone: str) -> Column:
    """A field as text for the reject logs; bytes are shown in hex."""
    if isinstance(source_type, T.BinaryType):
        return F.hex(value)
    return C.to_text(value, source_type, zone)


def rejected_line(df: DataFrame, zone: str = "UTC") -> Column:
    """All fields of a row joined by a bar, NULLs spelled out."""
    return rejected_line_of(df.schema, zone)


def rejected_line_of(schema: T.StructType, zone: str) -> Column:
    shown = [F.coalesce(show_value(column(f.name), f.dataType, zone), F.lit(NULL_TEXT)) for f in schema.fields]
    return F.concat_ws(SEPARATOR, *shown)


@dataclass(frozen=True)
class CheckedRows:
    """Source rows with their conformed values and the position of the first failing column."""

    checked: DataFrame
    source_schema: T.StructType
    mapped: list[MappedField]
    spec: LoadSpec
    reasons: list[str] = field(default_factory=list)

    @property
    def is_good(self) -> Column:
        return F.col(REJECT_INDEX).isNull()

    @property
    def is_bad(self) -> Column:
        return F.col(REJECT_INDEX).isNotNull()

    def _source_columns(self) -> list[Column]:
        return [column(f.name) for f in self.source_schema.fields]

    def _pick(self, texts: list[str | None]) -> Column:
        """The text that belongs to the failing column, NULL for good rows."""
        # element_at plans a NULL position as never NULL, hence the condition
        return F.when(self.is_bad, F.element_at(F.array(*[F.lit(t) for t in texts]), F.col(REJECT_INDEX) + 1))

    def with_checked(self, checked: DataFrame) -> CheckedRows:
        return CheckedRows(checked, self.source_schema, self.mapped, self.spec, self.reasons)

    @property
    def reason(self) -> Column:
        """Reject reason of a row, NULL for good rows."""
        return self._pick(self.reasons)

    def loaded_columns(self) -> list[Column]:
        return [F.col(_loaded_name(i)).alias(m.target.name) for i, m in enumerate(self.mapped)]

    @property
    def accepted(self) -> DataFrame:
        """Good rows with all their source fields, unmapped ones included."""
        return self.checked.where(self.is_good).select(self._source_columns())

    @property
    def loaded(self) -> DataFrame:
        """Good rows as target columns."""
        return self.checked.where(self.is_good).select(self.loaded_columns())

    def bad_rows(self) -> DataFrame:
        """Bad rows as far as the reject logs need them: source fields and the failing column."""
        return self.checked.where(self.is_bad).select(*self._source_columns(), REJECT_INDEX)

    @property
    def all_rows(self) -> DataFrame:
        """Every source row with its reason."""
        return self.checked.select(*self._source_columns(), self.reason.alias("reject_reason"))

    def line(self) -> Column:
        """All source fields as one line."""
        return rejected_line_of(self.source_schema, self.spec.time_zone)

    def failing_value(self) -> Column:
        """The value that did not fit, as text."""
        value = F
        for i, m in enumerate(self.mapped):  # one flat CASE, however many columns
            value = value.when(
                F.col(REJECT_INDEX) == i, show_value(column(m.source.name), m.source.dataType, self.spec.time_zone))
        return value

    def rejected_columns(self) -> list[Column]:
        return [
            *self._source_columns(),
            self.line().alias("rejected_line"),
            self.reason.alias("reject_reason"),
            F.current_timestamp().alias("rejected_at"),
        ]

    def exception_columns(self) -> list[Column]:
        return [
            F.current_timestamp().alias("rejected_at"),
            self._pick([m.target.name for m in self.mapped]).alias("column"),
            self._pick([m.target.type_text for m in self.mapped]).alias("target_type"),
            self.failing_value().alias("value"),
            self.reason.alias("reason"),
        ]

    @property
    def rejected(self) -> DataFrame:
        """Bad rows: source fields, one line of text, the reason and the time."""
        return self.checked.where(self.is_bad).select(self.rejected_columns())

    @property
    def exceptions(self) -> DataFrame:
        """One row per bad row: which column failed, on what value and why."""
        return self.checked.where(self.is_bad).select(self.exception_columns())

    def summary(self) -> DataFrame:
        """Rejects counted by column and reason; at most one group per target column."""
        counts = self.checked.where(self.is_bad).groupBy(REJECT_INDEX).agg(F.count(F.lit(1)).alias("rows"))
        return counts.select(
            self._pick([m.target.name for m in self.mapped]).alias("column"), self.reason.alias("reason"), "rows"
        )

    def profile(self, top: int = 10) -> DataFrame:
        """The ``top`` most frequent failing values of each column, beside its rejected rows and its number of different failing values.

        Counts are exact. Equal values are added up in the tasks first, and each task hands on its ``top`` values of a column only,
        so neither a value that fails very often nor a column with very many failing values ends up in one task. Ties go to the smaller value.
        """
        bad = self.checked.where(self.is_bad).select(REJECT_INDEX, self.failing_value().alias("value"))
        counts = bad.groupBy(REJECT_INDEX, "value").agg(F.count(F.lit(1)).alias("value_rows"))
        order = Window.partitionBy(REJECT_INDEX).orderBy(F.desc("value_rows"), "value")
        first = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        totals = counts.groupBy(REJECT_INDEX).agg(F.sum("value_rows").alias("rows"), F.count(F.lit(1)).alias("values"))
        return first.join(totals, REJECT_INDEX).select(
            self._pick([m.target.name for m in self.mapped]).alias("column"), self.reason.alias("reason"), "rows", "values",
            "rank", "value", "value_rows")

    def counts(self) -> DataFrame:
        """One row: read, accepted and rejected rows."""
        return self.checked.select(REJECT_INDEX).agg(*count_columns())


def count_columns() -> list[Column]:
    bad = F.col(REJECT_INDEX).isNotNull()
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~bad).alias("rows_accepted"),
        F.count_if(bad).alias("rows_rejected"),
    ]


def reject_reason(m: MappedField) -> str:
    target = m.target
    if target.type_name in ("CHAR", "VARCHAR", "BINARY", "VARBINARY"):
        return f"{target.name}: longer than {target.length} bytes"
    return f"{target.name}: not a {target.type_text}"


def validate(df: DataFrame, spec: LoadSpec, passthrough: bool = True, barrier: bool = True) -> CheckedRows:
    """Conform every mapped field and mark rows that do not fit.

    Without ``passthrough`` only mapped fields are kept, so a scan reads no other columns. The ``barrier``
    is a row count between the conversions and whatever filters them. It keeps the optimizer from moving
    the filter below the conversions, where they would run twice, and where filter inference would
    take time exponential in the number of columns.
    """
    mapped = resolve_mapping(df.schema, spec)
    if not mapped:
        raise LoadPlanError("no fields to load")
    taken = [f.name for f in df.schema.fields if f.name.lower().startswith(PREFIX)]
    if taken:
        raise LoadPlanError(f"field names starting with {PREFIX} are reserved: {', '.join(taken)}")

    mapped_names = {m.source.name for m in mapped}
    kept = [f for f in df.schema.fields if passthrough or f.name in mapped_names]
    conformed = [
        C.conform(column(m.source.name), m.source.dataType, m.target, spec.time_zone, spec.precision)
        .alias(_loaded_name(i))
        for i, m in enumerate(mapped)
    ]
    rows = df.select(*[column(f.name) for f in kept], *conformed)

    checks = [
        F.when(column(m.source.name).isNotNull() & F.col(_loaded_name(i)).isNull(), F.lit(i))
        for i, m in enumerate(mapped) if C.may_reject(m.source.dataType, m.target)
    ]
    first = F.coalesce(*checks) if checks else F.lit(None).cast("int")
    checked = rows.withColumn(REJECT_INDEX, first)
    if barrier:
        checked = checked.observe(f"checked-{uuid4().hex}", F.count(F.lit(1)).alias("rows"))
    return CheckedRows(checked, T.StructType(kept), mapped, spec, [reject_reason(m) for m in mapped])


def split_rejects(df: DataFrame, spec: LoadSpec) -> tuple[DataFrame, DataFrame]:
    """Accepted source rows and rejected ones."""
    rows = validate(df, spec)
    return rows.accepted, rows.rejected


def passthrough(df: DataFrame, spec: LoadSpec) -> DataFrame:
    """Rows a load takes, with all their original fields."""
    return validate(df, spec).accepted
