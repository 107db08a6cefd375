"""Epoch milliseconds, timestamps without zone, and their calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms_to_timestamp(ms: Column) -> Column:
    """Whole seconds since 1970 as a timestamp without zone; the milliseconds are cut off toward zero."""
    seconds = F.call_function("div", ms.cast("bigint"), F.lit(1000))
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + seconds * F.expr("interval '1' second")


def timestamp_to_epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a timestamp without zone, independent of the session time zone."""
    days = F.date_diff(ts.cast("date"), F.expr("date'1970-01-01'")).cast("bigint")
    millis = F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return days * 86_400_000 + F.hour(ts) * F.lit(3_600_000) + F.minute(ts) * F.lit(60_000) + millis


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Parts of the time dimension: ISO week, calendar year, weekday 0 = Sunday."""
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": F.dayofweek(ts) - 1,
    }
