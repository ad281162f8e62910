"""What to load: target columns, field mapping and load settings."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

from sluice.errors import LoadPlanError

# The target type names a load accepts.
INTEGER_TYPES = ("INTEGER", "BIGINT")
FLOAT_TYPES = ("FLOAT", "DOUBLE PRECISION")
TEXT_TYPES = ("CHAR", "VARCHAR")
BINARY_TYPES = ("BINARY", "VARBINARY")
INTERVAL_TYPES = ("INTERVAL", "INTERVAL DAY TO SECOND")
DATE_FAMILY = ("DATE", "TIME", "TIMETZ", "TIMESTAMP", "TIMESTAMPTZ")
TARGET_TYPES = (
    INTEGER_TYPES + ("BOOLEAN",) + FLOAT_TYPES + TEXT_TYPES + DATE_FAMILY
    + INTERVAL_TYPES + BINARY_TYPES + ("NUMERIC",)
)

DEFAULT_NUMERIC = (37, 15)
LOG_FORMATS = ("parquet", "json", "text")
INTEGER_SPARK_TYPES = {1: T.ByteType(), 2: T.ShortType(), 4: T.IntegerType(), 8: T.LongType()}


@dataclass(frozen=True)
class TargetColumn:
    """One column of the target table.

    ``length`` is bytes for CHAR/VARCHAR/BINARY/VARBINARY and total digits for NUMERIC, ``scale`` the
    digits after the point. ``width`` is the byte width of an INTEGER (1, 2, 4 or 8). ``fixed`` turns a
    BINARY column into a zero-padded fixed-width one; by default BINARY behaves like VARBINARY.
    """

    name: str
    type_name: str
    length: int | None = None
    scale: int | None = None
    width: int = 8
    fixed: bool = False

    def __post_init__(self):
        kind = " ".join(self.type_name.upper().split())
        object.__setattr__(self, "type_name", kind)
        if kind not in TARGET_TYPES:
            raise LoadPlanError(f"column {self.name}: type {self.type_name} is not supported")
        if kind in INTEGER_TYPES and self.width not in INTEGER_SPARK_TYPES:
            raise LoadPlanError(f"column {self.name}: an INTEGER is 1, 2, 4 or 8 bytes wide, not {self.width}")
        if self.length is not None and self.length < 1:
            raise LoadPlanError(f"column {self.name}: length must be positive")
        if self.length is None and (kind == "CHAR" or self.fixed):
            raise LoadPlanError(f"column {self.name}: {kind} needs a length")
        if kind == "NUMERIC":
            digits, scale = self.digits
            if not 0 <= scale <= digits <= 38:
                raise LoadPlanError(f"column {self.name}: NUMERIC({digits},{scale}) does not fit 38 digits")

    @property
    def digits(self) -> tuple[int, int]:
        """Digits and scale of a NUMERIC column."""
        if self.length is None:
            return DEFAULT_NUMERIC
        return self.length, self.scale or 0

    @property
    def type_text(self) -> str:
        """The type as people write it, used in reject reasons."""
        if self.type_name == "NUMERIC":
            return "NUMERIC({},{})".format(*self.digits)
        if self.type_name in INTEGER_TYPES and self.width != 8:
            return f"{self.type_name}({self.width} bytes)"
        if self.length is not None:
            return f"{self.type_name}({self.length})"
        return self.type_name

    @property
    def spark_type(self) -> T.DataType:
        """The Spark type of the conformed value."""
        kind = self.type_name
        if kind in INTEGER_TYPES:
            return INTEGER_SPARK_TYPES[self.width]
        if kind == "NUMERIC":
            return T.DecimalType(*self.digits)
        if kind in BINARY_TYPES:
            return T.BinaryType()
        if kind in TEXT_TYPES:
            return T.StringType()
        # TIME, TIMETZ and INTERVAL travel as microseconds
        return {
            "BOOLEAN": T.BooleanType(),
            "DATE": T.DateType(),
            "TIMESTAMP": T.TimestampNTZType(),
            "TIMESTAMPTZ": T.TimestampType(),
        }.get(kind, T.DoubleType() if kind in FLOAT_TYPES else T.LongType())

    @property
    def table_type(self) -> T.DataType:
        """The Spark type a created table declares, with CHAR/VARCHAR lengths kept."""
        if self.type_name == "CHAR":
            return T.CharType(self.length)
        if self.type_name == "VARCHAR" and self.length is not None:
            return T.VarcharType(self.length)
        return self.spark_type


@dataclass(frozen=True)
class LoadSpec:
    """Settings of one load.

    ``fields`` lists (stream field, target column) pairs; without it fields map by position.
    ``time_zone`` turns wall-clock input into instants and back; the session time zone is never used.
    ``precision`` is ``"millis"`` (sub-millisecond digits are dropped) or ``"micros"``.
    Blank reject paths switch the corresponding log off; ``log_format`` is ``"parquet"``, ``"json"`` or
    ``"text"`` (one time-stamped entry per rejected row). ``abort_log`` says what the logs hold after an abort: ``"all"``
    bad rows, which takes a pass over the input of its own, or the ``"first"`` that failed the load. ``most_rejects`` is the
    number of bad rows that a load without ``abort_on_error`` puts up with.
    """

    columns: tuple[TargetColumn, ...]
    fields: tuple[tuple[str | None, str], ...] | None = None
    table: str | None = None
    abort_on_error: bool = True
    rejected_path: str | None = None
    exceptions_path: str | None = None
    log_format: str = "parquet"
    stream_name: str | None = None
    connection: str | None = None
    time_zone: str = "UTC"
    precision: str = "millis"
    abort_log: str = "all"
    most_rejects: int | None = None

    def __post_init__(self):
        object.__setattr__(self, "columns", tuple(self.columns))
        if self.fields is not None:
            object.__setattr__(self, "fields", tuple((s, c) for s, c in self.fields))
        for setting in ("rejected_path", "exceptions_path", "stream_name"):
            value = getattr(self, setting)
            object.__setattr__(self, setting, value if value and value.strip() else None)
        if self.precision not in ("millis", "micros"):
            raise LoadPlanError(f"precision is 'millis' or 'micros', not {self.precision!r}")
        if self.log_format not in LOG_FORMATS:
            raise LoadPlanError(f"log_format is one of {', '.join(LOG_FORMATS)}, not {self.log_format!r}")
        if self.most_rejects is not None and self.most_rejects < 0:
            raise LoadPlanError(f"most_rejects is a number of rows, not {self.most_rejects}")
        if self.abort_log not in ("all", "first"):
            raise LoadPlanError(f"abort_log is 'all' or 'first', not {self.abort_log!r}")
        names = [c.name.lower() for c in self.columns]
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise LoadPlanError(f"target columns listed twice: {', '.join(repeated)}")

    def with_options(self, **changes) -> LoadSpec:
        return replace(self, **changes)

    def column(self, name: str) -> TargetColumn | None:
        for c in self.columns:
            if c.name.lower() == name.lower():
                return c
        return None
