"""Table schemas, keys and sort orders of the two staging tables and the five star-schema tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DataType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MAX_TEXT = 256  # declared length of every text column

_STR, _INT, _LONG = StringType(), IntegerType(), LongType()
COORDINATE = DecimalType(20, 6)


def _struct(*columns: tuple[str, DataType, bool]) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in columns])


def duration_type(scale: int = 4) -> DecimalType:
    """Song length; the constraint-free variant of the model keeps two decimals instead of four."""
    return DecimalType(12, scale)


STAGING_EVENTS = _struct(
    ("artist", _STR, True),
    ("auth", _STR, True),
    ("firstName", _STR, True),
    ("gender", _STR, True),
    ("itemInSession", _INT, True),
    ("lastName", _STR, True),
    ("length", DecimalType(18, 0), True),
    ("level", _STR, True),
    ("location", _STR, True),
    ("method", _STR, True),
    ("page", _STR, True),
    ("registration", _STR, True),
    ("sessionId", _INT, True),
    ("song", _STR, True),
    ("status", _STR, True),
    ("ts", _LONG, True),
    ("userAgent", _STR, True),
    ("userId", _INT, True),
)

# JSON path of each staging column, matched by position.
EVENT_PATHS = [f"$['{name}']" for name in STAGING_EVENTS.names]


def staging_songs(duration_scale: int = 4) -> StructType:
    return _struct(
        ("num_songs", _INT, True),
        ("artist_id", _STR, True),
        ("artist_latitude", COORDINATE, True),
        ("artist_longitude", COORDINATE, True),
        ("artist_location", _STR, True),
        ("artist_name", _STR, True),
        ("song_id", _STR, True),
        ("title", _STR, True),
        ("duration", duration_type(duration_scale), True),
        ("year", _INT, True),
    )


SONGPLAYS = _struct(
    ("songplay_id", _LONG, True),
    ("start_time", TimestampNTZType(), False),
    ("user_id", _INT, False),
    ("level", _STR, True),
    ("song_id", _STR, False),
    ("artist_id", _STR, False),
    ("session_id", _INT, False),
    ("location", _STR, True),
    ("user_agent", _STR, True),
)

USERS = _struct(
    ("user_id", _INT, False),
    ("first_name", _STR, False),
    ("last_name", _STR, False),
    ("gender", _STR, False),
    ("level", _STR, False),
)


def songs(duration_scale: int = 4) -> StructType:
    return _struct(
        ("song_id", _STR, False),
        ("title", _STR, False),
        ("artist_id", _STR, False),
        ("year", _INT, True),
        ("duration", duration_type(duration_scale), True),
    )


ARTISTS = _struct(
    ("artist_id", _STR, False),
    ("name", _STR, False),
    ("location", _STR, True),
    ("latitude", COORDINATE, True),
    ("longitude", COORDINATE, True),
)

TIME = _struct(
    ("start_time", TimestampNTZType(), False),
    ("hour", _INT, False),
    ("day", _INT, False),
    ("week", _INT, False),
    ("month", _INT, False),
    ("year", _INT, False),
    ("weekday", _INT, False),
)

# The unknown members and the page that marks a play.
UNKNOWN_SONG_ID = "***UNKNOWN_SONG***"
UNKNOWN_ARTIST_ID = "***UNKNOWN_ARTIST***"
UNKNOWN_SONG_TITLE = "***Unknown Song***"
UNKNOWN_ARTIST_NAME = "*** Unknown Artist ***"
PLAY_PAGE = "NextSong"

UNKNOWN_SONG = {
    "song_id": UNKNOWN_SONG_ID,
    "title": UNKNOWN_SONG_TITLE,
    "artist_id": UNKNOWN_ARTIST_ID,
}
UNKNOWN_ARTIST = {"artist_id": UNKNOWN_ARTIST_ID, "name": UNKNOWN_ARTIST_NAME}

# Storage column of tables that are divided by day; not part of their schemas.
DAY = "start_date"

# What identifies a play across loads.
PLAY_KEY = ["start_time", "user_id", "session_id"]


@dataclass(frozen=True)
class Table:
    name: str
    schema: StructType
    primary_key: str | None = None
    sort_by: list[str] = field(default_factory=list)
    # column -> referenced table; the referenced column has the same name
    references: dict[str, str] = field(default_factory=dict)
    # timestamp column whose day divides the stored files, if any
    day_of: str | None = None

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def star_tables(duration_scale: int = 4) -> dict[str, Table]:
    """All seven tables, referenced tables before the tables that refer to them."""
    tables = [
        Table("staging_events", STAGING_EVENTS),
        Table("staging_songs", staging_songs(duration_scale)),
        Table("time", TIME, "start_time", ["start_time"]),
        Table("users", USERS, "user_id", ["user_id"]),
        Table("artists", ARTISTS, "artist_id", ["artist_id"]),
        Table("songs", songs(duration_scale), "song_id", ["song_id"], {"artist_id": "artists"}),
        Table(
            "songplays",
            SONGPLAYS,
            "songplay_id",
            ["start_time", "user_id", "song_id", "artist_id"],
            {"start_time": "time", "user_id": "users", "song_id": "songs", "artist_id": "artists"},
            day_of="start_time",
        ),
    ]
    return {t.name: t for t in tables}
