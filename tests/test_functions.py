from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StringType

from starloom.functions.calendar import calendar_parts, epoch_ms_to_timestamp, timestamp_to_epoch_ms
from starloom.functions.conversion import convert, is_rejected, json_value
from starloom.functions.labels import decode, song_category
from starloom.schemas import UNKNOWN_SONG_ID
from tests.conftest import rows


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    "ms, expected",
    [
        (0, datetime(1970, 1, 1)),
        (999, datetime(1970, 1, 1)),
        (1999, datetime(1970, 1, 1, 0, 0, 1)),
        (-7, datetime(1970, 1, 1)),
        (-1500, datetime(1969, 12, 31, 23, 59, 59)),
        (1541105830796, datetime(2018, 11, 1, 20, 57, 10)),
        (None, None),
    ],
)
def test_epoch_is_cut_to_whole_seconds(spark, ms, expected):
    assert one(spark, epoch_ms_to_timestamp(F.lit(ms).cast("bigint")))[0] == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_conversion_ignores_the_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ts = F.expr("timestamp_ntz'2018-03-11 02:30:15.123456'")
        ms = timestamp_to_epoch_ms(ts)
        assert one(spark, ms)[0] == 1520735415123
        assert one(spark, epoch_ms_to_timestamp(ms))[0] == datetime(2018, 3, 11, 2, 30, 15)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def parts(spark, when):
    columns = calendar_parts(F.expr(f"timestamp_ntz'{when}'"))
    return one(spark, *[c.alias(n) for n, c in columns.items()]).asDict()


def test_last_day_of_year_may_be_week_one(spark):
    found = parts(spark, "2018-12-31 23:05:09")
    assert found == {"hour": 23, "day": 31, "week": 1, "month": 12, "year": 2018, "weekday": 1}


def test_sunday_is_zero(spark):
    assert parts(spark, "2018-11-04 00:00:00")["weekday"] == 0
    assert parts(spark, "2018-11-10 00:00:00")["weekday"] == 6


@settings(max_examples=25, deadline=None)
@given(moments=st.lists(st.datetimes(datetime(1970, 1, 1), datetime(2100, 1, 1)), min_size=1, max_size=20))
def test_calendar_agrees_with_python(spark, moments):
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    found = df.select("t", *[c.alias(n) for n, c in calendar_parts(F.col("t")).items()]).collect()
    for r in found:
        expected = (r.t.hour, r.t.day, r.t.isocalendar()[1], r.t.month, r.t.year, r.t.isoweekday() % 7)
        assert (r.hour, r.day, r.week, r.month, r.year, r.weekday) == expected


@pytest.mark.parametrize(
    "text, value, rejected",
    [("39", 39, False), ("", None, False), (" 39 ", 39, False), ("x", None, True), (None, None, False), ("3000000000", None, True)],
)
def test_text_to_integer(spark, text, value, rejected):
    raw = F.lit(text).cast("string")
    assert tuple(one(spark, convert(raw, IntegerType()), is_rejected(raw, IntegerType()))) == (value, rejected)


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("218.93179", DecimalType(12, 4), Decimal("218.9318")),
        ("218.93179", DecimalType(12, 2), Decimal("218.93")),
        ("243.5", DecimalType(18, 0), Decimal("244")),
        ("2.5", DecimalType(18, 0), Decimal("3")),
        ("1.540919166796E12", StringType(), "1.540919166796E12"),
        ("", StringType(), ""),
    ],
)
def test_text_to_declared_type(spark, text, kind, value):
    assert one(spark, convert(F.lit(text), kind))[0] == value


def test_text_beyond_declared_length_is_rejected(spark):
    found = one(spark, *[is_rejected(F.lit("é" * n), StringType()) for n in (256, 257)])
    assert tuple(found) == (False, True)


def test_json_value(spark):
    assert one(spark, json_value(F.lit('{"k": 7, "n": {"a": "b"}}'), "$.k"), json_value(F.lit("{}"), "$.k"))[:] == ("7", None)


def test_decode_and_category(spark):
    df = spark.createDataFrame([(0,), (8,), (5,), (None,)], "code int")
    assert rows(df.select(decode(F.col("code"), {0: "EVEN", 8: "ALL"}))) == [("????",), ("????",), ("ALL",), ("EVEN",)]
    ids = spark.createDataFrame([(UNKNOWN_SONG_ID,), ("SO1",)], "s string")
    assert rows(ids.select(song_category(F.col("s")))) == [("Known",), ("Unknown",)]
