"""Building the play fact from play events and the song catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.skew import HOT_ROWS, fits_broadcast, hot_lists, skew_join
from starloom.schemas import UNKNOWN_ARTIST_ID, UNKNOWN_SONG_ID

FACT_COLUMNS = [
    "start_time",
    "user_id",
    "level",
    "song_id",
    "artist_id",
    "session_id",
    "location",
    "user_agent",
]

NAME_KEYS = [("artist", "artist_name"), ("song", "title")]


def match_catalogue(
    plays: DataFrame, catalogue: DataFrame, hot_from: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Plays with ``song_id`` and ``artist_id`` of every catalogue row of the same artist name and title.

    Plays without a match keep one row with NULL ids; several matches give several rows.
    """
    names = catalogue.select("artist_name", "title", "song_id", "artist_id")
    return skew_join(plays, names, NAME_KEYS, "left", hot_from=hot_from, hot_rows=hot_rows)


def resolve_songs(
    plays: DataFrame,
    catalogue: DataFrame,
    extra: Sequence[str] = (),
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fact rows, with the unknown members where the catalogue has no id."""
    return (
        match_catalogue(plays, catalogue, hot_from, hot_rows)
        .withColumn("song_id", F.coalesce("song_id", F.lit(UNKNOWN_SONG_ID)))
        .withColumn("artist_id", F.coalesce("artist_id", F.lit(UNKNOWN_ARTIST_ID)))
        .select(*FACT_COLUMNS, *extra)
    )


def resolve_with_source_text(
    plays: DataFrame,
    catalogue: DataFrame,
    extra: Sequence[str] = (),
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fact rows that fall back to the event's own song and artist text."""
    return (
        match_catalogue(plays, catalogue, hot_from, hot_rows)
        .withColumn("song_id", F.coalesce("song_id", "song"))
        .withColumn("artist_id", F.coalesce("artist_id", "artist"))
        .select(*FACT_COLUMNS, *extra)
    )


def resolve_loose(
    plays: DataFrame,
    artists: DataFrame,
    songs: DataFrame,
    extra: Sequence[str] = (),
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Artist by name and song by title, each on its own: a title may meet another artist's song.

    Every row carries the constant ``dummy`` 9999 in place of a key. ``hot_from`` (``artist``, ``song``) is scanned for the
    frequent names of both joins at once, instead of ``plays``.
    """
    by_name = artists.select(F.col("name").alias("__name"), "artist_id")
    by_title = songs.select(F.col("title").alias("__title"), "song_id")
    hot_artists = hot_songs = None
    if not (fits_broadcast(by_name) and fits_broadcast(by_title)):
        hot_artists, hot_songs = hot_lists(plays if hot_from is None else hot_from, [["artist"], ["song"]], hot_rows)
    with_artist = skew_join(plays, by_name, [("artist", "__name")], "left", hot_rows=hot_rows, left_hot=hot_artists)
    with_both = skew_join(with_artist, by_title, [("song", "__title")], "left", hot_rows=hot_rows, left_hot=hot_songs)
    return (
        with_both.withColumn("song_id", F.coalesce("song_id", "song"))
        .withColumn("artist_id", F.coalesce("artist_id", "artist"))
        .select(F.lit(9999).alias("dummy"), *FACT_COLUMNS, *extra)
    )
