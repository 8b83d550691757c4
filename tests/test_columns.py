import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sensorloom.functions import day_number, event_time, utc_day, with_day
from tests.conftest import tuples

EDGES = [-1, 0, 86_399, 86_400, 1_704_267_600, -62_135_596_800, 253_402_300_799, 253_402_300_800]
FAR = [1_704_267_600_000, 1_704_267_600_000_000, 2**63 - 1, -(2**63), 9_223_372_036_854, -9_223_372_036_855]


@pytest.fixture(params=["UTC", "America/Los_Angeles", "Pacific/Auckland"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def _seconds(spark, values):
    return spark.createDataFrame([(v,) for v in values], "timestamp bigint")


def test_day_is_utc_in_every_session_zone(spark, zone):
    df = _seconds(spark, [-1, 0, 86_399, None, 1_704_267_600])
    assert [row[0] for row in df.select(utc_day()).collect()] == [
        "1969-12-31",
        "1970-01-01",
        "1970-01-01",
        None,
        "2024-01-03",
    ]


def test_day_agrees_with_the_calendar(spark, zone):
    rng = random.Random(7)
    values = [rng.randrange(-60_000_000_000, 250_000_000_000) for _ in range(500)]
    days = [row[0] for row in _seconds(spark, values).select(utc_day()).collect()]
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    assert days == [(start + timedelta(seconds=v)).strftime("%Y-%m-%d").rjust(10, "0") for v in values]


def test_day_equals_formatting_a_utc_timestamp_even_out_of_range(spark):
    """A second far outside the calendar saturates instead of failing the job."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        formatted = F.date_format(F.col("timestamp").cast("timestamp"), "yyyy-MM-dd")
        for ours, theirs in _seconds(spark, EDGES + FAR).select(utc_day(), formatted).collect():
            assert ours == theirs
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_day_number_floors_and_keeps_null(spark):
    df = _seconds(spark, [-86_401, -86_400, -1, 0, 86_400, None])
    assert [row[0] for row in df.select(day_number()).collect()] == [-2, -1, -1, 0, 1, None]


def test_with_day_adds_text(sample):
    df = with_day(sample)
    assert dict(df.dtypes)["day"] == "string"
    assert {row["day"] for row in df.collect()} == {"2024-01-03"}


def test_event_time_is_the_same_instant(spark, zone):
    df = _seconds(spark, [-1, 1_704_267_600, None]).select(F.unix_seconds(event_time()).alias("s"))
    assert tuples(df) == sorted([(-1,), (1_704_267_600,), (None,)], key=repr)


def test_event_time_saturates(spark):
    df = _seconds(spark, [2**63 - 1, -(2**63)]).select(F.unix_seconds(event_time()))
    assert [row[0] for row in df.collect()] == [9_223_372_036_854, -9_223_372_036_854]
