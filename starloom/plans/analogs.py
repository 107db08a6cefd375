"""Play-log and catalogue views over the driver's Parquet tables, shaped like the staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType

from starloom.functions.calendar import timestamp_to_epoch_ms
from starloom.functions.conversion import convert, json_value
from starloom.operators.skew import skew_join
from starloom.schemas import COORDINATE, duration_type

PLAY = "view"  # the event type that stands for a play

# What an earlier load had seen: events before these instants, songs up to this year.
LOADED_PLAYS_BEFORE = "2024-01-16 00:00:00"
LOADED_USERS_BEFORE = "2024-01-02 00:00:00"
LOADED_SONGS_UNTIL = 1

TITLE_BLOCK = 64  # parts with neighbouring keys that draw on the same titles
CATALOGUED_SIZE = 40


class Tables:
    """The Parquet tables of one driver folder; each is opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]


def event_log(tables: Tables) -> DataFrame:
    """The part of the staged events that the events table alone holds."""
    session = json_value(F.col("props"), "$.k")
    return tables["events"].select(
        F.when(F.col("value") >= 50, F.lit("paid")).otherwise(F.lit("free")).alias("level"),
        F.col("value").cast(DecimalType(18, 0)).alias("length"),
        F.concat(F.lit("L"), session).alias("location"),
        F.col("event_type").alias("page"),
        convert(session, IntegerType()).alias("sessionid"),
        timestamp_to_epoch_ms(F.col("ts")).alias("ts"),
        F.col("props").alias("useragent"),
        F.col("user_id").alias("userid"),
        "event_id",
    )


def song_title() -> Column:
    """Title of a part. Parts of one block of keys share titles, so a title has a few songs at any size of the table."""
    return F.concat("p_name", F.lit(" "), F.floor(F.col("p_partkey") / TITLE_BLOCK).cast("string"))


def song_names(tables: Tables) -> DataFrame:
    """Artist and song that an event can name, by ``event_id``."""
    song = F.when(F.col("p_size") > CATALOGUED_SIZE, F.concat(song_title(), F.lit(" (live)"))).otherwise(song_title())
    return tables["part"].select(F.col("p_partkey").alias("event_id"), F.col("p_type").alias("artist"), song.alias("song"))


def with_song_names(events: DataFrame, tables: Tables) -> DataFrame:
    """Adds ``artist`` and ``song``; about one event in five has them. Both keys are unique, so no key is frequent.

    Large parts stand for recordings the catalogue does not have. The names grow with the events, and their estimate from
    compressed files is far below what a broadcast of them holds, so both sides are shuffled by key instead.
    """
    return events.join(song_names(tables).hint("merge"), "event_id", "left")


def with_people(events: DataFrame, tables: Tables) -> DataFrame:
    """Adds the attributes of the user."""
    people = tables["customer"].select(
        "c_custkey",
        F.col("c_name").alias("firstname"),
        F.concat(F.lit("N"), F.col("c_nationkey")).alias("lastname"),
        F.col("c_mktsegment").alias("gender"),
    )
    users = tables["events"].select(F.col("user_id").alias("userid"))
    return skew_join(events, people, [("userid", "c_custkey")], "left", right_unique=True, hot_from=users)


def stage_events(tables: Tables) -> DataFrame:
    return with_people(with_song_names(event_log(tables), tables), tables)


# Where the columns of an event stand in its JSON text.
EVENT_DOCUMENT = {
    "level": "$.level",
    "length": "$['length']",
    "location": "$['place']['name']",
    "page": "$['page']",
    "sessionid": "$['session'][1]",
    "ts": "$['session'][0]",
    "useragent": "$.agent",
    "userid": "$.user.ids[0].id",
}
SONG_DOCUMENT = {
    "num_songs": "$.num_songs",
    "artist_id": "$.artist.id",
    "artist_latitude": "$.artist.place[0]",
    "artist_longitude": "$.artist.place[1]",
    "artist_location": "$.artist.location",
    "artist_name": "$.artist.name",
    "song_id": "$.song_id",
    "title": "$.title",
    "duration": "$.duration",
    "year": "$.year",
}
BROKEN_PAGE = "signup"  # documents of this page are cut off
BROKEN_SIZE = 50  # so are those of parts of this size


def event_documents(tables: Tables) -> DataFrame:
    """``event_id`` and the event as a JSON text with objects and arrays inside; some texts lack their end."""
    whole = F.to_json(
        F.struct(
            "level",
            "length",
            F.struct(F.col("location").alias("name")).alias("place"),
            "page",
            F.array("ts", F.col("sessionid").cast("bigint")).alias("session"),
            F.col("useragent").alias("agent"),
            F.struct(F.array(F.struct(F.col("userid").alias("id"))).alias("ids")).alias("user"),
        )
    )
    document = F.when(F.col("page") == BROKEN_PAGE, F.substr(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    return event_log(tables).select("event_id", document.alias("document"))


def song_documents(tables: Tables) -> DataFrame:
    """``p_partkey`` and the catalogue row as a JSON text; some texts lack their end."""
    c = F.col
    artist = F.struct(
        c("artist_id").alias("id"), F.array(c("artist_latitude"), c("artist_longitude")).alias("place"),
        c("artist_location").alias("location"), c("artist_name").alias("name"),
    )
    rows = stage_songs(tables).withColumn("p_partkey", F.expr("substr(song_id, 3)").cast("bigint"))
    whole = F.to_json(F.struct("num_songs", artist.alias("artist"), "song_id", "title", "duration", "year"))
    document = F.when(c("year") == BROKEN_SIZE, F.substr(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    return rows.select("p_partkey", document.alias("document"))


def event_text(tables: Tables) -> DataFrame:
    """``event_id`` and text columns of events, some of which do not fit: counts with a unit, ids that are names, agents
    that go on and on."""
    user, length = F.col("userid").cast("string"), F.col("length").cast("string")
    return event_log(tables).select(
        "event_id",
        "level",
        F.when(F.col("page") == "click", F.concat(length, F.lit(" s"))).otherwise(length).alias("length"),
        "page",
        F.when(F.col("page") == "signup", F.lit(" ")).otherwise(F.col("sessionid").cast("string")).alias("sessionid"),
        F.when(F.col("page") == "purchase", F.concat(F.lit("u"), user)).otherwise(user).alias("userid"),
        F.when(F.col("page") == "error", F.repeat(F.coalesce("useragent", F.lit("?")), F.lit(200))).otherwise(F.col("useragent")).alias("useragent"),
    )


def stage_songs(tables: Tables) -> DataFrame:
    """The parts as a catalogue; a few rows share an artist name and title."""
    key = F.col("p_partkey").cast("string")
    return (
        tables["part"]
        .select(
            F.lit(1).alias("num_songs"),
            F.concat(F.lit("AR"), (F.col("p_partkey") % 50).cast("string")).alias("artist_id"),
            F.col("p_retailprice").cast(COORDINATE).alias("artist_latitude"),
            F.col("p_size").cast(COORDINATE).alias("artist_longitude"),
            F.col("p_brand").alias("artist_location"),
            F.col("p_type").alias("artist_name"),
            F.concat(F.lit("SO"), key).alias("song_id"),
            song_title().alias("title"),
            F.col("p_retailprice").cast(duration_type()).alias("duration"),
            F.col("p_size").alias("year"),
        )
    )
