"""Epoch-2000 encodings of dates and times, one BIGINT each.

Wall-clock values are split into calendar fields, and instants are moved between zones with
``from_utc_timestamp``/``to_utc_timestamp`` on the UTC axis. Neither depends on the session time zone;
``timestampdiff`` and ``date_trunc`` are avoided because they pass zone-less values through it.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F, types as T

# Fixed values of the encodings.
EPOCH_2000_DAYS = 10957  # days from 1970-01-01 to 2000-01-01
EPOCH_2000_MICROS = 946684800000000
DAY_MICROS = 86400000000
TIMETZ_ZONE_BITS = 24
TIMETZ_UTC = 86400  # UTC, plus 24 hours in seconds


def is_date_like(source_type: T.DataType) -> bool:
    return isinstance(source_type, (T.DateType, T.TimestampType, T.TimestampNTZType))


def truncate(micros: Column, precision: str = "millis") -> Column:
    """Drop sub-millisecond digits (towards the past), unless micros are wanted."""
    return micros - F.pmod(micros, F.lit(1000)) if precision == "millis" else micros


def _clock_micros(value: Column) -> Column:
    seconds = F.date_part(F.lit("SECOND"), value)
    return (
        F.hour(value) * F.lit(3600000000)
        + F.minute(value) * F.lit(60000000).cast("bigint")
        + (seconds * F.lit(1000000)).cast("bigint")
    )


def wall_micros(value: Column, source_type: T.DataType, zone: str = "UTC") -> Column:
    """Wall-clock microseconds since 1970-01-01 00:00, daylight saving ignored."""
    if isinstance(source_type, T.DateType):
        return F.unix_date(value) * F.lit(DAY_MICROS)
    if isinstance(source_type, T.TimestampNTZType):
        return F.unix_date(value.cast("date")) * F.lit(DAY_MICROS) + _clock_micros(value)
    return F.unix_micros(value if zone == "UTC" else F.from_utc_timestamp(value, zone))


def instant_micros(value: Column, source_type: T.DataType, zone: str = "UTC") -> Column:
    """Microseconds since 1970-01-01 00:00 UTC; wall-clock input is read in ``zone``."""
    if isinstance(source_type, T.TimestampType):
        return F.unix_micros(value)
    wall = wall_micros(value, source_type)
    if zone == "UTC":
        return wall
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(wall), zone))


def ntz_from_micros(micros: Column) -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.lit(timedelta(microseconds=1)) * micros


def wall_date(value: Column, source_type: T.DataType, zone: str = "UTC") -> Column:
    """Calendar date of a value, in ``zone`` for instants."""
    if isinstance(source_type, T.TimestampType):
        micros = wall_micros(value, source_type, zone)
        midnight = micros - F.pmod(micros, F.lit(DAY_MICROS))
        return F.date_from_unix_date(F.call_function("div", midnight, F.lit(DAY_MICROS)).cast("int"))
    return value.cast("date")


def encode_date(value: Column, source_type: T.DataType, zone: str = "UTC") -> Column:
    """Days since 2000-01-01."""
    return F.unix_date(wall_date(value, source_type, zone)).cast("bigint") - F.lit(EPOCH_2000_DAYS)


def encode_timestamp(value: Column, source_type: T.DataType, zone: str = "UTC", precision: str = "millis") -> Column:
    """Wall-clock microseconds since 2000-01-01 00:00."""
    return truncate(wall_micros(value, source_type, zone), precision) - F.lit(EPOCH_2000_MICROS)


def encode_timestamptz(value: Column, source_type: T.DataType, zone: str = "UTC", precision: str = "millis") -> Column:
    """Microseconds between an instant and 2000-01-01 00:00 UTC."""
    return truncate(instant_micros(value, source_type, zone), precision) - F.lit(EPOCH_2000_MICROS)


def encode_time(value: Column, source_type: T.DataType, zone: str = "UTC", precision: str = "millis") -> Column:
    """Wall-clock microseconds since midnight."""
    if isinstance(source_type, T.TimestampNTZType):
        return truncate(_clock_micros(value), precision)
    return truncate(F.pmod(wall_micros(value, source_type, zone), F.lit(DAY_MICROS)), precision)


def encode_timetz(value: Column, source_type: T.DataType, zone: str = "UTC", precision: str = "millis") -> Column:
    """UTC microseconds since midnight in the upper 40 bits, the fixed UTC zone in the lower 24."""
    clock = truncate(F.pmod(instant_micros(value, source_type, zone), F.lit(DAY_MICROS)), precision)
    return F.shiftleft(clock, TIMETZ_ZONE_BITS) + F.lit(TIMETZ_UTC).cast("bigint")


def encode_interval(value: Column, source_type: T.DataType) -> Column:
    """Microseconds of a day-time interval; integers are microseconds already."""
    if isinstance(source_type, T.DayTimeIntervalType):
        seconds = value.cast("interval second").cast("decimal(19,6)")
        return (seconds * F.lit(1000000)).cast("bigint")
    return value.cast("bigint")
