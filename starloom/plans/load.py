"""The batch load: stage two JSON collections, then build four dimensions and the fact. Safe to run again."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.functions.conversion import convert, is_rejected
from starloom.operators import dimensions as d
from starloom.operators.facts import resolve_songs
from starloom.operators.filters import plays_only, select_play_columns
from starloom.operators.incremental import absent_members, missing_member, new_keys_only, null_key_count, within_range_of
from starloom.operators.star import count_tables
from starloom.operators.surrogate_keys import assign_ids
from starloom.operators.upsert import update_users
from starloom.schemas import PLAY_KEY, PLAY_PAGE, UNKNOWN_ARTIST, UNKNOWN_SONG, star_tables
from starloom.session import discard, materialize, work_folder
from starloom.sources import json_files as j
from starloom.sources.ledger import Ledger, file_tag
from starloom.sources.tables import (
    FILE_BYTES,
    REJECTS,
    append,
    append_files,
    append_rejects,
    files_for,
    lay_out,
    load,
    load_between,
    replace,
    reserve_ids,
    stored_bytes,
)

# Last event of a user: by time, then by position in the session.
EVENT_ORDER = ("ts", "sessionid", "iteminsession")
FACT_ORDER = (
    "start_time",
    "user_id",
    "song_id",
    "artist_id",
    "session_id",
    "level",
    "location",
    "user_agent",
)


@dataclass
class LoadResult:
    before: list[Row] = field(default_factory=list)
    after: list[Row] = field(default_factory=list)
    rejected: dict[str, int] = field(default_factory=dict)
    files: dict[str, int] = field(default_factory=dict)  # staged from each collection, if each is staged once
    undone: list[tuple[str, str]] = field(default_factory=list)  # (batch, table) of loads that had failed
    seconds: float = 0.0
    batch: str = field(default_factory=lambda: uuid.uuid4().hex)


def _strict(text: DataFrame, schema: StructType) -> DataFrame:
    """Typed columns; the first value that does not fit fails the job, so nothing of the batch is stored."""
    columns = []
    for f in schema.fields:
        raw = F.col(f.name)
        message = F.concat(F.lit(f"{f.name} cannot hold: "), raw)
        checked = F.when(is_rejected(raw, f.dataType), F.raise_error(message)).otherwise(convert(raw, f.dataType))
        columns.append(checked.cast(f.dataType).alias(f.name))
    return text.select(*columns)


def stage(
    spark: SparkSession,
    database: str,
    name: str,
    text: DataFrame,
    mode: str = "overwrite",
    on_reject: str = "fail",
    max_rejects: int | None = None,
    batch: str = "",
    tag: str | None = None,
) -> int:
    """Load one staging table from text columns. Returns the number of rejected values (0 unless ``on_reject='null'``).

    With ``on_reject='null'`` the rows are read and written once: values that do not fit are NULL, and stand next to them
    in a column of the files that the table does not show. From there they go to the rejects table, whole and with their
    batch. More than ``max_rejects`` of them fail the load, and neither table changes. With ``tag``, which goes with
    ``mode='append'``, the names of all files written begin with it.
    """
    if mode not in ("overwrite", "append") or on_reject not in ("fail", "null"):
        raise ValueError(f"mode={mode!r}, on_reject={on_reject!r}")
    if tag and mode != "append":
        raise ValueError("only appended files are tagged")
    add = append if tag is None else partial(append_files, tag=tag)
    schema = load(spark, database, name).schema
    if on_reject == "fail":
        rows = _strict(text, schema)
        if mode == "append":
            add(rows, database, name)
        else:
            replace(rows, database, name, keep_previous=False, check_text=False)
        return 0

    seen = Observation()
    rows = j.with_rejects(text, schema).observe(seen, F.coalesce(F.sum(F.size(REJECTS)), F.lit(0)).alias("n_rejected"))

    def store_rejects(folder: str) -> None:
        found = seen.get["n_rejected"]
        if max_rejects is not None and found > max_rejects:
            raise ValueError(f"{found} values of {name} do not fit, more than {max_rejects}")
        if found:
            written = spark.read.schema(f"{REJECTS} array<{j.REJECT}>").parquet(folder)
            append_rejects(j.rejected_values(written), database, name, batch, tag or "part")

    if mode == "overwrite":
        replace(rows, database, name, keep_previous=False, check_text=False, hidden=[REJECTS], before_switch=store_rejects)
    else:
        work = work_folder(spark)
        try:
            rows = materialize(rows, work)
            store_rejects(work)
            add(rows.drop(REJECTS), database, name)
        finally:
            discard(spark, work)
    return seen.get["n_rejected"]


def _nulls(rows: DataFrame, name: str, columns: Sequence[str], on_reject: str) -> dict[str, int]:
    """NULLs in required columns as ``table.column``; with ``on_reject='fail'`` the first load step that has any fails."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    found = {f"{name}.{c}": counts[c] for c in columns if counts[c]}
    if found and on_reject == "fail":
        raise ValueError(f"NULL in required columns: {found}")
    return found


def load_dimensions(
    spark: SparkSession,
    database: str,
    page: str = PLAY_PAGE,
    event_order: Sequence[str] = EVENT_ORDER,
    on_reject: str = "null",
) -> dict[str, int]:
    """Add new members to the four dimensions, and bring existing users up to date. Returns NULLs in required columns.

    New members are appended; only the users table is written anew, in a folder of its own, because it is updated.
    """
    events = load(spark, database, "staging_events")
    catalogue = load(spark, database, "staging_songs")

    rejected: dict[str, int] = {}

    def add(name: str, members: DataFrame, key: str) -> None:
        columns = [c for c in star_tables()[name].required if c in members.columns]
        rejected.update(_nulls(members, name, columns, on_reject) if columns else {})
        append(lay_out(members, [key]), database, name)

    def dim(name: str) -> DataFrame:
        return load(spark, database, name)

    add("users", absent_members(dim("users"), d.users_from(events, page), "user_id"), "user_id")
    replace(lay_out(update_users(dim("users"), events, event_order), ["user_id"]), database, "users")

    times = d.start_times(plays_only(events, page))
    known = within_range_of(dim("time"), times, "start_time")
    new_times = new_keys_only(times, known, ["start_time"], source_unique=True)
    add("time", d.with_calendar(new_times), "start_time")

    add("artists", absent_members(dim("artists"), d.artists_from(catalogue), "artist_id"), "artist_id")
    append(missing_member(dim("artists"), UNKNOWN_ARTIST, "artist_id"), database, "artists")
    add("songs", absent_members(dim("songs"), d.songs_from(catalogue), "song_id"), "song_id")
    append(missing_member(dim("songs"), UNKNOWN_SONG, "song_id"), database, "songs")
    return rejected


def load_fact(
    spark: SparkSession,
    database: str,
    page: str = PLAY_PAGE,
    n_partitions: int | None = None,
    on_reject: str = "null",
    file_bytes: int = FILE_BYTES,
) -> dict[str, int]:
    """Append plays whose (start time, user, session) the fact does not have, with ids that go on from the last one.

    Plays with a NULL in that key are not loaded; returns how many there are.
    The batch is stored in sorted files of about ``file_bytes``, by the bytes that its rows take before they are numbered.
    """
    plays = select_play_columns(plays_only(load(spark, database, "staging_events"), page))
    n_rejected = null_key_count(plays, PLAY_KEY).first()["n_rejected"]
    if n_rejected and on_reject == "fail":
        raise ValueError(f"{n_rejected} plays without {', '.join(PLAY_KEY)}")
    rejected = {"songplays": n_rejected} if n_rejected else {}
    span = plays.agg(F.min("start_time").alias("low"), F.max("start_time").alias("high")).first()
    if span.low is None:
        return rejected
    known = load_between(spark, database, "songplays", "start_time", span.low, span.high)
    new_plays = new_keys_only(plays, known, PLAY_KEY, prune_target=True)
    rows = resolve_songs(new_plays, load(spark, database, "staging_songs"), hot_from=plays)

    work = work_folder(spark)
    try:
        # The batch is written once: ids are reserved for its rows before any is stored, so they must not change.
        rows = materialize(rows, work)
        keyed = assign_ids(
            rows,
            FACT_ORDER,
            start=lambda n: reserve_ids(spark, database, "songplays", "songplay_id", n),
            n_partitions=n_partitions,
        )
        append(keyed, database, "songplays", files_for(stored_bytes(spark, work), file_bytes))
    finally:
        discard(spark, work)
    return rejected


def run_load(
    spark: SparkSession,
    database: str,
    events_prefix: str,
    songs_prefix: str,
    event_mapping: Mapping[str, str] | None = None,
    skip_staging: bool = False,
    skip_dwh: bool = False,
    skip_count: bool = False,
    staging_mode: str = "overwrite",
    on_reject: str = "fail",
    page: str = PLAY_PAGE,
    n_partitions: int | None = None,
    event_paths_file: str | None = None,
    max_rejects: int | None = None,
    once: bool = False,
    file_bytes: int = FILE_BYTES,
) -> LoadResult:
    """Stage, build and count. Each step commits on its own; after a failure the same call completes the load.

    With ``once``, which goes with ``staging_mode="append"``, a ledger keeps the files that have been staged: only new
    files are read, rows of a load that failed between its first and last write are removed first, and a call that finds
    no new file stages nothing. ``file_bytes`` is the size of the files of the fact.

    The columns of events come from ``event_mapping`` (column -> JSON path), or from the paths of ``event_paths_file`` one
    by one, or from the fields of the same names. ``max_rejects`` limits the values of each staging table that
    ``on_reject='null'`` may set aside in the rejects table, under ``LoadResult.batch``.
    """
    result, began = LoadResult(), time.perf_counter()
    if event_mapping and event_paths_file:
        raise ValueError("give event_mapping or event_paths_file, not both")
    if once and staging_mode != "append":
        raise ValueError("files are staged once in append mode only")

    def count(tag: str) -> list[Row]:
        frames = {name: load(spark, database, name) for name in star_tables()}
        return count_tables(frames, tag).collect()  # seven rows

    if not skip_count:
        result.before = count("before")
    if not skip_staging:
        events_schema = load(spark, database, "staging_events").schema
        songs_schema = load(spark, database, "staging_songs").schema
        if event_paths_file:
            events_mapping = j.by_position(j.read_paths_file(spark, event_paths_file), events_schema)
        else:
            events_mapping = event_mapping or j.by_name(events_schema)
        sources = {
            "staging_events": (events_prefix, events_mapping),
            "staging_songs": (songs_prefix, j.by_name(songs_schema)),
        }
        ledger = Ledger(spark, database).create() if once else None
        if ledger:
            result.undone = ledger.undo_unfinished()
        for name, (prefix, mapping) in sources.items():
            files = ledger.begin(result.batch, name, prefix) if ledger else None
            if files is not None:
                result.files[name] = len(files)
                if not files:
                    result.rejected[name] = 0
                    continue
            text = j.read_text_columns(spark, prefix, mapping, files=files)
            tag = file_tag(result.batch, name) if ledger else None
            result.rejected[name] = stage(spark, database, name, text, staging_mode, on_reject, max_rejects, result.batch, tag)
            if ledger:
                ledger.note(result.batch, name, "stored")
    if not skip_dwh:
        result.rejected |= load_dimensions(spark, database, page, on_reject=on_reject)
        result.rejected |= load_fact(spark, database, page, n_partitions, on_reject, file_bytes)
    if not skip_count:
        result.after = count("after")
    result.seconds = time.perf_counter() - began
    return result
