"""The registered queries: every operator over the whole driver tables; those of stored tables write tables of their own."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from starloom.functions.calendar import epoch_ms_to_timestamp
from starloom.functions.conversion import convert
from starloom.functions.labels import decode
from starloom.operators import dimensions as d
from starloom.operators import facts, filters, incremental, quality, references, star
from starloom.operators.surrogate_keys import assign_ids
from starloom.operators.upsert import changed_members, update_users, users_with_updates
from starloom.plans import analogs as a
from starloom.schemas import PLAY_KEY, STAGING_EVENTS, UNKNOWN_ARTIST, UNKNOWN_SONG, USERS, staging_songs, star_tables
from starloom.session import work_folder
from starloom.sources import json_files as j
from starloom.sources import tables
from starloom.sources.colocated import Colocated

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAGE_CODES = {"view": "V", "click": "C", "purchase": "P", "signup": "S"}
EVENT_ORDER = ("ts", "event_id")


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


class Star:
    """Frames of one driver folder, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.tables = a.Tables(spark, sf_dir)

    @cached_property
    def log(self) -> DataFrame:
        return a.event_log(self.tables)

    @cached_property
    def people(self) -> DataFrame:
        return a.with_people(self.log, self.tables)

    @cached_property
    def named(self) -> DataFrame:
        return a.with_song_names(self.log, self.tables)

    @cached_property
    def events(self) -> DataFrame:
        return a.stage_events(self.tables)

    @cached_property
    def catalogue(self) -> DataFrame:
        return a.stage_songs(self.tables)

    @cached_property
    def plays(self) -> DataFrame:
        return filters.select_play_columns(filters.plays_only(self.named, a.PLAY), "event_id")

    @cached_property
    def fact(self) -> DataFrame:
        return facts.resolve_songs(self.plays, self.catalogue, ["event_id"])

    @cached_property
    def users(self) -> DataFrame:
        return d.users_from(self.people, a.PLAY)

    @cached_property
    def current_users(self) -> DataFrame:
        return update_users(self.users, self.people, EVENT_ORDER)

    @cached_property
    def reported_users(self) -> DataFrame:
        return users_with_updates(self.people, EVENT_ORDER, a.PLAY)

    @cached_property
    def play_keys(self) -> DataFrame:
        """What plays refer to, from the events alone; scanned for frequent keys instead of the fact."""
        return filters.plays_only(self.log, a.PLAY).select(
            epoch_ms_to_timestamp(F.col("ts")).alias("start_time"), F.col("userid").alias("user_id"), "event_id"
        )

    @cached_property
    def songs(self) -> DataFrame:
        return incremental.ensure_member(d.songs_from(self.catalogue), UNKNOWN_SONG, "song_id")

    @cached_property
    def artists(self) -> DataFrame:
        return incremental.ensure_member(d.artists_from(self.catalogue), UNKNOWN_ARTIST, "artist_id")

    @cached_property
    def time(self) -> DataFrame:
        return d.time_from(self.log, a.PLAY)

    @cached_property
    def dims(self) -> dict[str, tuple[DataFrame, str]]:
        return {
            "time": (self.time, "start_time"),
            "users": (self.users, "user_id"),
            "songs": (self.songs, "song_id"),
            "artists": (self.artists, "artist_id"),
        }

    def members(self, catalogue: DataFrame | None = None, plays: str | None = None, users: str | None = None) -> dict[str, tuple[DataFrame, str]]:
        """Keys of the four dimensions alone, each from one scan: of all rows, or of what an earlier load had seen."""
        songs = self.catalogue if catalogue is None else catalogue

        def events(before: str | None) -> DataFrame:
            return filters.plays_only(self.log if before is None else _before(self.log, before), a.PLAY)

        def with_unknown(key: str, unknown: dict) -> DataFrame:
            one = songs.sparkSession.range(1).select(F.lit(unknown[key]).alias(key))
            return songs.select(key).dropna().union(one).distinct()

        return {
            "time": (d.start_times(events(plays)), "start_time"),
            "users": (events(users).select(F.col("userid").alias("user_id")).dropna().distinct(), "user_id"),
            "songs": (with_unknown("song_id", UNKNOWN_SONG), "song_id"),
            "artists": (with_unknown("artist_id", UNKNOWN_ARTIST), "artist_id"),
        }

    @cached_property
    def children(self) -> dict[str, DataFrame]:
        """The tables that refer to others."""
        unknown = {"song_id": UNKNOWN_SONG["song_id"], "artist_id": UNKNOWN_SONG["artist_id"]}
        one = self.catalogue.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in unknown.items()])
        # The least artist of a song has a text buffer, so equal pairs are counted first.
        pairs = self.catalogue.select(*unknown).dropna(subset=["song_id"]).union(one)
        return {"songplays": self.fact, "songs": incremental.first_version(pairs, "song_id", {"artist_id": "artist_id"})}


def _before(events: DataFrame, instant: str) -> DataFrame:
    return events.filter(epoch_ms_to_timestamp(F.col("ts")) < F.expr(f"timestamp_ntz'{instant}'"))


# --- staging -------------------------------------------------------------------------------------------------------


@registered
def stage_events(spark, sf_dir):
    return Star(spark, sf_dir).events


@registered
def stage_songs(spark, sf_dir):
    return Star(spark, sf_dir).catalogue


def _fields(*names: str) -> StructType:
    """Declared columns of staged events, by their names in lower case."""
    known = {f.name.lower(): f.dataType for f in STAGING_EVENTS.fields}
    return StructType([StructField(n, known[n]) for n in names])


@registered
def stage_events_json(spark, sf_dir):
    """Events from JSON texts by path, through objects and arrays; a broken text gives NULLs and a mark."""
    schema = _fields(*a.EVENT_DOCUMENT)
    text = j.parse_text_columns(a.event_documents(a.Tables(spark, sf_dir)), "document", a.EVENT_DOCUMENT, ["event_id"])
    columns = [convert(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]
    return text.select("event_id", *columns, F.col(j.CORRUPT).isNotNull().alias("broken"))


@registered
def stage_songs_json(spark, sf_dir):
    """The catalogue from JSON texts by path."""
    text = j.parse_text_columns(a.song_documents(a.Tables(spark, sf_dir)), "document", a.SONG_DOCUMENT, ["p_partkey"])
    columns = [convert(F.col(f.name), f.dataType).alias(f.name) for f in staging_songs().fields]
    return text.select("p_partkey", *columns, F.col(j.CORRUPT).isNotNull().alias("broken"))


def _with_rejects(spark, sf_dir) -> DataFrame:
    text = a.event_text(a.Tables(spark, sf_dir))
    return j.with_rejects(text, _fields(*[c for c in text.columns if c != "event_id"]), keep=["event_id"])


@registered
def load_accepted(spark, sf_dir):
    """Typed events, NULL where a value does not fit, and how many values that are."""
    rows = _with_rejects(spark, sf_dir)
    return rows.select(*[c for c in rows.columns if c != "rejects"], F.size("rejects").alias("n_rejected"))


@registered
def load_rejects(spark, sf_dir):
    """The values that do not fit, whole, with their column and the reason."""
    return j.rejected_values(_with_rejects(spark, sf_dir), keep=["event_id"])


@registered
def plays_only(spark, sf_dir):
    return filters.plays_only(Star(spark, sf_dir).events, a.PLAY)


@registered
def in_list(spark, sf_dir):
    return filters.value_in(Star(spark, sf_dir).events, "page", ["view", "click"])


@registered
def case_decode(spark, sf_dir):
    code = decode(F.col("page"), PAGE_CODES).alias("code")
    return star.rows_per_key(Star(spark, sf_dir).log.select("page", code), ["page", "code"])


@registered
def epoch_to_timestamp(spark, sf_dir):
    return d.start_times(Star(spark, sf_dir).log)


# --- dimensions ----------------------------------------------------------------------------------------------------


@registered
def users_dim(spark, sf_dir):
    return Star(spark, sf_dir).users


@registered
def songs_dim(spark, sf_dir):
    return Star(spark, sf_dir).songs


@registered
def artists_dim(spark, sf_dir):
    return Star(spark, sf_dir).artists


@registered
def time_dim(spark, sf_dir):
    return Star(spark, sf_dir).time


@registered
def ensure_member_idempotent(spark, sf_dir):
    once = Star(spark, sf_dir).songs
    return incremental.ensure_member(once, UNKNOWN_SONG, "song_id")


@registered
def users_incremental(spark, sf_dir):
    s = Star(spark, sf_dir)
    loaded = d.users_from(_before(s.people, a.LOADED_USERS_BEFORE), a.PLAY)
    return incremental.absent_members(loaded, s.users, "user_id")


@registered
def songs_incremental(spark, sf_dir):
    catalogue = Star(spark, sf_dir).catalogue
    loaded = d.songs_from(catalogue.filter(F.col("year") <= a.LOADED_SONGS_UNTIL))
    return incremental.absent_members(loaded, d.songs_from(catalogue), "song_id")


@registered
def artists_incremental(spark, sf_dir):
    catalogue = Star(spark, sf_dir).catalogue
    loaded = d.artists_from(catalogue.filter(F.col("year") <= a.LOADED_SONGS_UNTIL))
    return incremental.absent_members(loaded, d.artists_from(catalogue), "artist_id")


@registered
def time_incremental(spark, sf_dir):
    log = Star(spark, sf_dir).log
    loaded = d.time_from(_before(log, a.LOADED_PLAYS_BEFORE), a.PLAY)
    times = d.start_times(filters.plays_only(log, a.PLAY))
    return d.with_calendar(incremental.new_keys_only(times, loaded, ["start_time"], source_unique=True))


@registered
def users_upsert(spark, sf_dir):
    return Star(spark, sf_dir).current_users


@registered
def users_changed(spark, sf_dir):
    s = Star(spark, sf_dir)
    columns = [c for c in USERS.names if c != "user_id"]
    return changed_members(s.users, s.current_users, "user_id", columns)


# --- fact ----------------------------------------------------------------------------------------------------------


@registered
def songplays_full(spark, sf_dir):
    return Star(spark, sf_dir).fact


@registered
def songplays_incremental(spark, sf_dir):
    s = Star(spark, sf_dir)
    plays = s.plays
    loaded = plays.filter(F.col("start_time") < F.expr(f"timestamp_ntz'{a.LOADED_PLAYS_BEFORE}'"))
    new_plays = incremental.new_keys_only(plays, loaded, PLAY_KEY)
    return facts.resolve_songs(new_plays, s.catalogue, ["event_id"], hot_from=plays)


@registered
def songplays_fallback(spark, sf_dir):
    s = Star(spark, sf_dir)
    return facts.resolve_with_source_text(s.plays, s.catalogue, ["event_id"])


@registered
def songplays_keyed(spark, sf_dir):
    s = Star(spark, sf_dir)
    return assign_ids(s.fact, ["event_id", "song_id"], cuts_from=s.play_keys.select("event_id"))


@registered
def loose_preview(spark, sf_dir):
    s = Star(spark, sf_dir)
    return facts.resolve_loose(s.plays, s.artists, s.songs, ["event_id"], hot_from=a.song_names(s.tables))


@registered
def like_song(spark, sf_dir):
    return filters.with_prefix(Star(spark, sf_dir).fact, "song_id", "SO")


@registered
def like_artist(spark, sf_dir):
    return filters.with_prefix(Star(spark, sf_dir).fact, "artist_id", "AR")


@registered
def not_like_song(spark, sf_dir):
    return filters.without_prefix(Star(spark, sf_dir).fact, "song_id", "SO")


@registered
def preview_songplays(spark, sf_dir):
    return filters.preview(Star(spark, sf_dir).fact, 10, ["event_id", "song_id"])


# --- reports -------------------------------------------------------------------------------------------------------


@registered
def count_tables(spark, sf_dir):
    """Rows of the seven tables. The lookups that staged events carry are unique, so the events are counted before them;
    a dimension has as many rows as keys."""
    s = Star(spark, sf_dir)
    frames = {
        "staging_events": s.log,
        "staging_songs": s.catalogue,
        "songplays": s.fact,
        **{name: keys for name, (keys, _) in s.members().items()},
    }
    return star.count_tables(frames)


@registered
def count_joins(spark, sf_dir):
    """The four joins of the fact with its dimensions, counted in one pass over the fact."""
    s = Star(spark, sf_dir)
    return references.joined_counts(s.fact, s.members()).select("dimension", F.col("joined_rows").alias("n"))


@registered
def count_fact_time(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.referential_count(s.fact, s.time, "start_time")


@registered
def count_fact_users(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.referential_count(s.fact, s.users, "user_id")


@registered
def count_fact_songs(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.referential_count(s.fact, s.songs, "song_id")


@registered
def count_fact_artists(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.referential_count(s.fact, s.artists, "artist_id")


@registered
def plays_by_week(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.plays_by(s.fact, {"start_time": s.time}, ["year", "month", "week"])


@registered
def plays_by_week_level(spark, sf_dir):
    s = Star(spark, sf_dir)
    dims = {"start_time": s.time, "user_id": s.reported_users}
    return star.plays_by(s.fact, dims, ["year", "month", "week", "level"], hot_from=s.play_keys)


@registered
def plays_by_week_gender(spark, sf_dir):
    s = Star(spark, sf_dir)
    dims = {"start_time": s.time, "user_id": s.reported_users}
    return star.plays_by(s.fact, dims, ["year", "month", "week", "gender"], hot_from=s.play_keys)


@registered
def known_unknown(spark, sf_dir):
    return star.match_rate(Star(spark, sf_dir).fact)


@registered
def songs_artists(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.songs_with_artists(s.songs, s.artists)


@registered
def songs_artists_count(spark, sf_dir):
    s = Star(spark, sf_dir)
    return star.referential_count(s.songs, s.artists, "artist_id")


@registered
def topk_songs(spark, sf_dir):
    return star.top_k(Star(spark, sf_dir).songs, ["song_id"], 5)


# --- stored tables -------------------------------------------------------------------------------------------------


def _new_database(spark) -> str:
    """Tables of their own below the work folder; their files are what the result is read from."""
    name = f"starloom_{uuid.uuid4().hex}"
    tables.create_tables(spark, name, work_folder(spark))
    return name


@registered
def stored_users(spark, sf_dir):
    """The users table after a first load, a later load of new members, and the update: created, appended to, replaced."""
    s = Star(spark, sf_dir)
    database = _new_database(spark)
    tables.append(_as_table(d.users_from(_before(s.people, a.LOADED_USERS_BEFORE), a.PLAY), "users"), database, "users")
    new = incremental.absent_members(tables.load(spark, database, "users"), _as_table(s.users, "users"), "user_id")
    tables.append(new, database, "users")
    people = s.people.withColumn("userid", F.col("userid").cast("int"))
    tables.replace(update_users(tables.load(spark, database, "users"), people, EVENT_ORDER), database, "users")
    return tables.load(spark, database, "users")


@registered
def stored_time(spark, sf_dir):
    """The time table after it was filled, cleared, and filled by two loads, the second over all events."""
    s = Star(spark, sf_dir)
    database = _new_database(spark)
    earlier = d.time_from(_before(s.log, a.LOADED_PLAYS_BEFORE), a.PLAY)
    tables.append(earlier.limit(5), database, "time")
    tables.clear(spark, database, "time")
    tables.append(tables.lay_out(earlier, ["start_time"]), database, "time")
    known = incremental.within_range_of(tables.load(spark, database, "time"), s.time, "start_time")
    new = incremental.new_keys_only(s.time, known, ["start_time"], source_unique=True)
    tables.append(tables.lay_out(new, ["start_time"]), database, "time")
    return tables.load(spark, database, "time")


def _colocated(spark, name: str, key: str) -> tuple[Colocated, str]:
    database = f"starloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{database}`")
    return Colocated(spark, database, name, key, int(spark.conf.get("spark.sql.shuffle.partitions"))), work_folder(spark)


@registered
def colocated_users(spark, sf_dir):
    """Plays by level and gender from a copy of the fact divided by user, after two loads and the update of the users."""
    s = Star(spark, sf_dir)
    store, folder = _colocated(spark, "plays_by_user", "user_id")
    plays = s.fact.select("event_id", "start_time", "user_id")
    earlier = F.coalesce(F.col("start_time") < F.expr(f"timestamp_ntz'{a.LOADED_PLAYS_BEFORE}'"), F.lit(False))
    store.create(plays.filter(earlier), s.users, folder, hot_from=s.play_keys.filter(earlier))
    store.append(plays.filter(~earlier), hot_from=s.play_keys.filter(~earlier))
    store.replace_members(s.current_users)
    return store.counted(["level", "gender"])


@registered
def colocated_songs(spark, sf_dir):
    """Every play with its song, from a copy of the fact divided by song; the unknown song has most plays."""
    s = Star(spark, sf_dir)
    store, folder = _colocated(spark, "plays_by_song", "song_id")
    store.create(s.fact.select("event_id", "song_id"), s.songs.select("song_id", "title", "year"), folder)
    return store.joined()


def _as_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the columns and types of a table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in star_tables()[name].schema.fields])


# --- checks --------------------------------------------------------------------------------------------------------


@registered
def dq_nulls(spark, sf_dir):
    events = Star(spark, sf_dir).events
    return quality.null_violations(events, events.columns)


@registered
def dq_required(spark, sf_dir):
    """NULLs in the required columns of the fact and its dimensions."""
    s = Star(spark, sf_dir)
    declared, frames = star_tables(), {"songplays": s.fact, **{name: dim for name, (dim, _) in s.dims.items()}}
    parts = []
    for name, frame in frames.items():
        columns = [c for c in declared[name].required if c in frame.columns]
        if columns:
            parts.append(quality.null_violations(frame, columns).select(F.lit(name).alias("table_name"), "column_name", "n_nulls"))
    return reduce(DataFrame.unionByName, parts)


@registered
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_keys(Star(spark, sf_dir).catalogue, ["artist_name", "title"])


@registered
def dq_orphans(spark, sf_dir):
    s = Star(spark, sf_dir)
    return quality.orphans(s.plays, s.catalogue, {"artist": "artist_name", "song": "title"})


@registered
def completeness(spark, sf_dir):
    s = Star(spark, sf_dir)
    return quality.completeness(s.fact, s.members())


@registered
def dq_foreign_keys(spark, sf_dir):
    """The five declared references, checked over the whole tables."""
    s = Star(spark, sf_dir)
    return references.foreign_keys(s.children, s.members(), references.declared(star_tables()))


@registered
def dq_orphan_keys(spark, sf_dir):
    """Keys that the dimensions of an earlier load do not have yet."""
    s = Star(spark, sf_dir)
    older = s.members(s.catalogue.filter(F.col("year") <= a.LOADED_SONGS_UNTIL), a.LOADED_PLAYS_BEFORE, a.LOADED_USERS_BEFORE)
    return references.orphan_keys(s.children, older, references.declared(star_tables()))


@registered
def dq_primary_keys(spark, sf_dir):
    """The five declared primary keys, checked over the whole tables."""
    s = Star(spark, sf_dir)
    keyed = assign_ids(s.fact, ["event_id", "song_id"], cuts_from=s.play_keys.select("event_id"))
    return references.primary_keys({**s.dims, "songplays": (keyed, "songplay_id")})
