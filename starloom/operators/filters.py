"""Projections and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import epoch_ms_to_timestamp
from starloom.schemas import PLAY_PAGE


def plays_only(events: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    return events.filter(F.col("page") == page)


def select_play_columns(events: DataFrame, *extra: str) -> DataFrame:
    """Fact-side columns of events, plus the names that find the song and any ``extra`` columns as they are."""
    return events.select(
        epoch_ms_to_timestamp(F.col("ts")).alias("start_time"),
        F.col("userid").alias("user_id"),
        "level",
        F.col("sessionid").alias("session_id"),
        "location",
        F.col("useragent").alias("user_agent"),
        "artist",
        "song",
        *extra,
    )


def with_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def without_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose value does not start with ``prefix``; NULL values satisfy neither form."""
    return df.filter(~F.col(column).startswith(prefix))


def value_in(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isin(values))


def preview(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """``n`` rows: the first in the given order, any rows without one."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
