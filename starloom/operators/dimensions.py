"""One row per member for the four dimensions, from staging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import calendar_parts, epoch_ms_to_timestamp
from starloom.operators.filters import plays_only
from starloom.operators.incremental import first_version, reject_null_keys
from starloom.schemas import PLAY_PAGE

# Output column <- staging column.
USER_COLUMNS = {"first_name": "firstname", "last_name": "lastname", "gender": "gender", "level": "level"}
SONG_COLUMNS = {"title": "title", "artist_id": "artist_id", "year": "year", "duration": "duration"}
ARTIST_COLUMNS = {
    "name": "artist_name",
    "location": "artist_location",
    "latitude": "artist_latitude",
    "longitude": "artist_longitude",
}


def users_from(events: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """Users with at least one play."""
    plays = reject_null_keys(plays_only(events, page), ["userid"])
    return first_version(plays.withColumnRenamed("userid", "user_id"), "user_id", USER_COLUMNS)


def songs_from(catalogue: DataFrame) -> DataFrame:
    return first_version(reject_null_keys(catalogue, ["song_id"]), "song_id", SONG_COLUMNS)


def artists_from(catalogue: DataFrame) -> DataFrame:
    return first_version(reject_null_keys(catalogue, ["artist_id"]), "artist_id", ARTIST_COLUMNS)


def start_times(events: DataFrame) -> DataFrame:
    """Distinct event seconds."""
    return reject_null_keys(events, ["ts"]).select(
        epoch_ms_to_timestamp(F.col("ts")).alias("start_time")
    ).distinct()


def with_calendar(times: DataFrame) -> DataFrame:
    return times.select("start_time", *[c.alias(n) for n, c in calendar_parts(F.col("start_time")).items()])


def time_from(events: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """Calendar row of every second with a play."""
    return with_calendar(start_times(plays_only(events, page)))
