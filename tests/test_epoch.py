"""Encodings against fixed vectors and the standard library, in several zones."""

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F, types as T

from sluice.functions import epoch

WALL, INSTANT, DAY = T.TimestampNTZType(), T.TimestampType(), T.DateType()
ZONES = ["UTC", "Asia/Anadyr", "Pacific/Apia", "US/Hawaii", "America/New_York"]
BASE = datetime(2000, 1, 1, tzinfo=timezone.utc)
MOMENTS = [
    datetime(2015, 3, 20), datetime(2000, 1, 1), datetime(1990, 2, 28), datetime(2015, 3, 8, 2, 30, 1, 999999),
    datetime(2024, 7, 4, 23, 59, 59, 123456), datetime(1969, 12, 31, 23, 59, 59, 999), datetime(1582, 10, 4, 1, 2, 3, 4),
]


def micros(delta):
    return (delta.days * 86400 + delta.seconds) * 10**6 + delta.microseconds


def one(spark, value, kind, encode):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", kind)]))
    return df.select(encode(F.col("v"))).first()[0]


@pytest.mark.parametrize("day, days", [
    (date(2015, 3, 20), 5557), (date(2000, 1, 1), 0), (date(1990, 2, 28), -3594), (None, None),
])
def test_date(spark, day, days):
    assert one(spark, day, DAY, lambda v: epoch.encode_date(v, DAY)) == days
    moment = day and datetime(day.year, day.month, day.day)
    assert one(spark, moment, WALL, lambda v: epoch.encode_date(v, WALL)) == days


@pytest.mark.parametrize("moment, expected", [
    (datetime(2015, 3, 20, 1), 480128400000000), (datetime(1990, 2, 28, 2), -310514400000000),
    (datetime(2000, 1, 1), 0), (datetime(2000, 1, 1, 11), 39600000000), (None, None),
])
def test_timestamp(spark, moment, expected):
    assert one(spark, moment, WALL, lambda v: epoch.encode_timestamp(v, WALL)) == expected


@pytest.mark.parametrize("moment", MOMENTS)
def test_timestamp_keeps_milliseconds(spark, moment):
    exact = micros(moment - datetime(2000, 1, 1))
    assert one(spark, moment, WALL, lambda v: epoch.encode_timestamp(v, WALL, precision="micros")) == exact
    assert one(spark, moment, WALL, lambda v: epoch.encode_timestamp(v, WALL)) == exact // 1000 * 1000
    clock = micros(moment - datetime(moment.year, moment.month, moment.day))
    assert one(spark, moment, WALL, lambda v: epoch.encode_time(v, WALL)) == clock // 1000 * 1000


@pytest.mark.parametrize("zone", ZONES)
@pytest.mark.parametrize("moment", MOMENTS[:3] + MOMENTS[4:5])
def test_timestamptz(spark, zone, moment):
    instant = moment.replace(tzinfo=ZoneInfo(zone))
    expected = micros(instant - BASE) // 1000 * 1000
    assert one(spark, moment, WALL, lambda v: epoch.encode_timestamptz(v, WALL, zone)) == expected
    assert one(spark, instant, INSTANT, lambda v: epoch.encode_timestamptz(v, INSTANT)) == expected


@pytest.mark.parametrize("zone", ZONES)
def test_instant_shows_wall_clock_of_zone(spark, zone):
    instant = datetime(2024, 7, 4, 23, 59, 59, 123456, timezone.utc)
    wall = instant.astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    expected = micros(wall - datetime(2000, 1, 1))
    assert one(spark, instant, INSTANT, lambda v: epoch.encode_timestamp(v, INSTANT, zone, "micros")) == expected
    assert one(spark, instant, INSTANT, lambda v: epoch.encode_date(v, INSTANT, zone)) == (wall.date() - date(2000, 1, 1)).days
    assert one(spark, instant, INSTANT, lambda v: epoch.encode_time(v, INSTANT, zone, "micros")) == \
        micros(wall - datetime(wall.year, wall.month, wall.day))


@pytest.mark.parametrize("zone", ZONES)
def test_timetz(spark, zone):
    midnight = datetime(2015, 3, 20, tzinfo=ZoneInfo(zone))
    utc = midnight.astimezone(timezone.utc)
    clock = micros(timedelta(hours=utc.hour, minutes=utc.minute))
    for value, kind in ((midnight, INSTANT), (midnight.replace(tzinfo=None), WALL)):
        packed = one(spark, value, kind, lambda v: epoch.encode_timetz(v, kind, zone))
        assert packed >> 24 == clock
        assert packed & 0xFFFFFF == 86400


@pytest.mark.parametrize("interval", [
    timedelta(days=-2, hours=3, microseconds=7), timedelta(0), timedelta(days=100000, seconds=1), None,
])
def test_interval(spark, interval):
    kind = T.DayTimeIntervalType()
    expected = None if interval is None else micros(interval)
    assert one(spark, interval, kind, lambda v: epoch.encode_interval(v, kind)) == expected


def test_plain_integer_is_an_interval_in_microseconds(spark):
    assert one(spark, 42, T.LongType(), lambda v: epoch.encode_interval(v, T.LongType())) == 42
