"""Conversions to the target column types.

Every function returns a Column that is NULL where the input is NULL or does not convert; a non-NULL
input with a NULL result is what ``operators.rejects`` turns into a reject. All are built-in
expressions, so they stay inside whole-stage code generation.

Conversion rules (this engine's contract):

* text to a number: the trimmed text must be a plain number, checked by pattern before the cast
* fractions to an integer: rounded to the nearest, halves up
* numbers to a boolean: true unless zero
* anything to text: Spark's string form; instants are shown in the load's time zone
* lengths are counted in UTF-8 bytes, and text that is too long is rejected, never cut

Values that do not fit are told apart by patterns and ranges before a cast sees them: a failing
``try_cast`` throws and catches an exception per row, some fifty times the cost of one that succeeds.
"""

from __future__ import annotations

import math
from datetime import timedelta
from decimal import Decimal

from pyspark.sql import Column, functions as F, types as T

from sluice.errors import LoadPlanError
from sluice.functions import epoch
from sluice.plans.spec import (
    BINARY_TYPES,
    FLOAT_TYPES,
    INTEGER_SPARK_TYPES,
    INTEGER_TYPES,
    INTERVAL_TYPES,
    TargetColumn,
)

# Patterns of plain numbers.
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SHORT_NUMBER = 18  # characters; text this short is within 64 bits
LARGEST_FRACTION = float(2**52)  # doubles from here on are whole
LONG_LIMIT = float(2**63)
LONG_MIN, LONG_MAX = Decimal(-(2**63)), Decimal(2**63 - 1)
SPACES = " \t\n\r\f\v"
TRUE_WORDS = ("t", "true", "y", "yes", "1")
FALSE_WORDS = ("f", "false", "n", "no", "0")

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)
_SCALAR = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType,
           T.TimestampNTZType, T.DayTimeIntervalType)


def _no_conversion(source_type, target):
    raise LoadPlanError(f"a {source_type.simpleString()} field cannot be loaded into {target}")


def _as_text(value: Column, source_type: T.DataType) -> Column:
    """Text form of a value; bytes that are no UTF-8 have none."""
    if isinstance(source_type, T.BinaryType):
        return F.when(F.is_valid_utf8(value.cast("string")), value.cast("string"))
    return value if isinstance(source_type, T.StringType) else value.cast("string")


def _decimal_to_long(value: Column) -> Column:
    return F.when(value.between(F.lit(LONG_MIN), F.lit(LONG_MAX)), value.try_cast("bigint"))


def to_integer(value: Column, source_type: T.DataType) -> Column:
    if isinstance(source_type, _INTEGRAL) or isinstance(source_type, T.BooleanType):
        return value.cast("bigint")
    if isinstance(source_type, T.StringType):
        short = F.length(value) <= SHORT_NUMBER
        number = F.when(short, value.try_cast("bigint")).otherwise(_decimal_to_long(value.try_cast("decimal(38,0)")))
        return F.when(value.rlike(INTEGER_PATTERN), number)
    if isinstance(source_type, _FRACTIONAL):
        x = value.cast("double")
        down = F.floor(x)
        rounded = down + F.when(x - down >= 0.5, 1).otherwise(0)
        in_range = (x >= -LONG_LIMIT) & (x < LONG_LIMIT)
        return F.when(F.abs(x) < LARGEST_FRACTION, rounded).when(in_range, x.cast("bigint"))
    if isinstance(source_type, T.DecimalType):
        down = F.floor(value)
        return _decimal_to_long(down + F.when(value - down >= 0.5, 1).otherwise(0))
    _no_conversion(source_type, "INTEGER")


def to_integer_n(value: Column, source_type: T.DataType, width: int) -> Column:
    """Integer of ``width`` bytes; values out of range are rejected, not wrapped."""
    whole = to_integer(value, source_type)
    if width == 8:
        return whole
    limit = 1 << (8 * width - 1)
    return F.when(whole.between(-limit, limit - 1), whole.try_cast(INTEGER_SPARK_TYPES[width]))


def to_boolean(value: Column, source_type: T.DataType) -> Column:
    if isinstance(source_type, T.BooleanType):
        return value
    if isinstance(source_type, T.StringType):
        word = F.lower(F.btrim(value, F.lit(SPACES)))
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    if isinstance(source_type, T.NumericType):
        return value != 0
    _no_conversion(source_type, "BOOLEAN")


def to_float(value: Column, source_type: T.DataType) -> Column:
    if isinstance(source_type, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if isinstance(source_type, T.StringType):
        number = F.when(value.rlike(NUMBER_PATTERN), value.try_cast("double"))
        return F.when(F.abs(number) < math.inf, number)  # a plain number may be too large
    _no_conversion(source_type, "FLOAT")


def to_numeric(value: Column, source_type: T.DataType, precision: int, scale: int) -> Column:
    target = T.DecimalType(precision, scale)
    whole_digits = precision - scale
    if isinstance(source_type, _FRACTIONAL):
        # just above the limit where the limit is not a double; the cast decides on the border
        limit = 10.0**whole_digits if whole_digits <= 22 else math.nextafter(10.0**whole_digits, math.inf)
        return F.when(F.abs(value) < limit, value.try_cast(target))
    if isinstance(source_type, T.BooleanType) or isinstance(source_type, _INTEGRAL) and whole_digits >= 19:
        return value.try_cast(target)
    if isinstance(source_type, T.NumericType):
        limit = F.lit(Decimal(10**min(whole_digits, 37)))
        in_range = (value > -limit) & (value < limit)
        return F.when(in_range, value.try_cast(target)) if whole_digits < 38 else value.try_cast(target)
    if isinstance(source_type, T.StringType):
        return F.when(value.rlike(NUMBER_PATTERN), value.try_cast(target))
    _no_conversion(source_type, f"NUMERIC({precision},{scale})")


def to_text(value: Column, source_type: T.DataType, zone: str = "UTC") -> Column:
    if isinstance(source_type, T.TimestampType):
        return epoch.ntz_from_micros(epoch.wall_micros(value, source_type, zone)).cast("string")
    return _as_text(value, source_type)


def to_varchar(value: Column, source_type: T.DataType, length: int | None = None, zone: str = "UTC") -> Column:
    text = to_text(value, source_type, zone)
    return text if length is None else F.when(F.octet_length(text) <= length, text)


def to_char(value: Column, source_type: T.DataType, length: int, zone: str = "UTC") -> Column:
    """Text padded with spaces to ``length`` bytes."""
    text = to_text(value, source_type, zone)
    size = F.octet_length(text)
    return F.when(size <= length, F.concat(text, F.repeat(F.lit(" "), F.lit(length) - size)))


def _as_bytes(value: Column, source_type: T.DataType, zone: str) -> Column:
    return value if isinstance(source_type, T.BinaryType) else to_text(value, source_type, zone).cast("binary")


def to_varbinary(value: Column, source_type: T.DataType, length: int | None = None, zone: str = "UTC") -> Column:
    data = _as_bytes(value, source_type, zone)
    return data if length is None else F.when(F.octet_length(data) <= length, data)


def to_binary(value: Column, source_type: T.DataType, length: int, zone: str = "UTC") -> Column:
    """Bytes padded with zeros to ``length``."""
    data = _as_bytes(value, source_type, zone)
    size = F.octet_length(data)
    padding = F.unhex(F.repeat(F.lit("00"), F.lit(length) - size))
    return F.when(size <= length, F.concat(data, padding))


def _date_like(source_type: T.DataType, target: str):
    if not epoch.is_date_like(source_type):
        raise LoadPlanError(
            f"a {source_type.simpleString()} field cannot be loaded into {target}: it must be a date or timestamp"
        )


def to_date(value: Column, source_type: T.DataType, zone: str = "UTC") -> Column:
    _date_like(source_type, "DATE")
    return epoch.wall_date(value, source_type, zone)


def to_time(value: Column, source_type: T.DataType, zone: str = "UTC", precision: str = "millis") -> Column:
    _date_like(source_type, "TIME")
    return epoch.encode_time(value, source_type, zone, precision)


def to_timetz(value: Column, source_type: T.DataType, zone: str = "UTC", precision: str = "millis") -> Column:
    _date_like(source_type, "TIMETZ")
    return epoch.encode_timetz(value, source_type, zone, precision)


def to_timestamp(value: Column, source_type: T.DataType, zone: str = "UTC", precision: str = "millis") -> Column:
    """Wall clock, without a zone."""
    _date_like(source_type, "TIMESTAMP")
    if isinstance(source_type, T.TimestampType):
        return epoch.ntz_from_micros(epoch.truncate(epoch.wall_micros(value, source_type, zone), precision))
    if isinstance(source_type, T.DateType):
        return value.cast("timestamp_ntz")
    if precision == "micros":
        return value
    fraction = (F.date_part(F.lit("SECOND"), value) * F.lit(1000000)).cast("bigint") % F.lit(1000)
    return value - F.lit(timedelta(microseconds=1)) * fraction


def to_timestamptz(value: Column, source_type: T.DataType, zone: str = "UTC", precision: str = "millis") -> Column:
    """Instant; wall-clock input is read in ``zone``."""
    _date_like(source_type, "TIMESTAMPTZ")
    if isinstance(source_type, T.TimestampType) and precision == "micros":
        return value
    return F.timestamp_micros(epoch.truncate(epoch.instant_micros(value, source_type, zone), precision))


def to_interval(value: Column, source_type: T.DataType) -> Column:
    if not isinstance(source_type, _INTEGRAL + (T.DayTimeIntervalType,)):
        _no_conversion(source_type, "INTERVAL")
    return epoch.encode_interval(value, source_type)


def conform(value: Column, source_type: T.DataType, target: TargetColumn, zone: str = "UTC",
            precision: str = "millis") -> Column:
    """``value`` as the type of ``target``; raises before any job if the types never convert."""
    kind = target.type_name
    if not isinstance(source_type, _SCALAR):
        _no_conversion(source_type, target.type_text)
    if kind in INTEGER_TYPES:
        return to_integer_n(value, source_type, target.width)
    if kind == "BOOLEAN":
        return to_boolean(value, source_type)
    if kind in FLOAT_TYPES:
        return to_float(value, source_type)
    if kind == "CHAR":
        return to_char(value, source_type, target.length, zone)
    if kind == "VARCHAR":
        return to_varchar(value, source_type, target.length, zone)
    if kind == "DATE":
        return to_date(value, source_type, zone)
    if kind == "TIME":
        return to_time(value, source_type, zone, precision)
    if kind == "TIMETZ":
        return to_timetz(value, source_type, zone, precision)
    if kind == "TIMESTAMP":
        return to_timestamp(value, source_type, zone, precision)
    if kind == "TIMESTAMPTZ":
        return to_timestamptz(value, source_type, zone, precision)
    if kind in INTERVAL_TYPES:
        return to_interval(value, source_type)
    if kind in BINARY_TYPES:
        if target.fixed:
            return to_binary(value, source_type, target.length, zone)
        return to_varbinary(value, source_type, target.length, zone)
    return to_numeric(value, source_type, *target.digits)


def may_reject(source_type: T.DataType, target: TargetColumn) -> bool:
    """False where the conversion cannot fail, so no check is planned for the column."""
    kind = target.type_name
    if kind in INTERVAL_TYPES or epoch.is_date_like(source_type) and kind not in ("CHAR", "VARCHAR") + BINARY_TYPES:
        return False
    if kind in INTEGER_TYPES:
        return not (target.width == 8 and isinstance(source_type, _INTEGRAL + (T.BooleanType,)))
    if kind == "BOOLEAN" or kind in FLOAT_TYPES:
        return isinstance(source_type, T.StringType)
    if kind == "VARCHAR":
        return target.length is not None or isinstance(source_type, T.BinaryType)
    if kind in ("VARBINARY", "BINARY"):
        return target.length is not None
    return True
