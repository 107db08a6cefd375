"""The whole load from JSON files, run once, run again, and over the rows that need care."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.__main__ import main
from starloom.operators import quality
from starloom.plans.load import run_load
from starloom.schemas import PLAY_KEY, UNKNOWN_ARTIST_ID, UNKNOWN_SONG_ID, star_tables
from starloom.sources import tables as t
from starloom.sources.ledger import Ledger
from tests.conftest import rows
from tests.test_sources import EVENT, write_json

SONG = {"num_songs": 1, "artist_id": "AR1", "artist_name": "A", "song_id": "SO1", "title": "T", "duration": 1.5, "year": 0}


class Warehouse:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.db = "load_" + folder.name.replace("-", "_")
        t.create_tables(spark, self.db, str(folder / "wh"))

    def events(self, name, *events):
        write_json(self.folder, f"log_data/2018/11/{name}.json", *[{**EVENT, **e} for e in events])

    def songs(self, name, *songs):
        write_json(self.folder, f"song_data/A/{name}.json", *[{**SONG, **s} for s in songs])

    def run(self, **options):
        return run_load(self.spark, self.db, str(self.folder / "log_data"), str(self.folder / "song_data"), **options)

    def table(self, name):
        return t.load(self.spark, self.db, name)

    def counts(self):
        return {name: self.table(name).count() for name in star_tables()}


@pytest.fixture
def wh(spark, tmp_path):
    warehouse = Warehouse(spark, tmp_path)
    yield warehouse
    t.drop_tables(spark, warehouse.db)


def fill(wh):
    wh.events(
        "2018-11-01",
        {"ts": 1000, "userId": "1", "sessionId": 1},  # known song
        {"ts": 2000, "userId": 2, "sessionId": 1, "song": "other"},  # unknown song
        {"ts": 3000, "userId": 1, "sessionId": 1, "page": "Home", "artist": None, "song": None, "level": "paid"},
        {"ts": 4000, "userId": "", "sessionId": 1, "page": "Login", "firstName": None, "artist": None, "song": None},
        {"ts": 5000, "userId": 3, "sessionId": 1, "page": "Home", "artist": None, "song": None},  # never plays
    )
    wh.songs("1", {})
    wh.songs("2", {"song_id": "SO2", "title": "U", "artist_id": "AR2", "artist_name": "B"})


def test_load_and_reload(wh):
    fill(wh)
    result = wh.run()
    assert {r.table_name: r.n for r in result.before} == dict.fromkeys(star_tables(), 0)
    expected = {"staging_events": 5, "staging_songs": 2, "time": 2, "users": 2, "artists": 3, "songs": 3, "songplays": 2}
    assert {r.table_name: r.n for r in result.after} == expected
    assert {r.tag for r in result.after} == {"after"}
    assert rows(wh.table("songplays").select("songplay_id", "user_id", "song_id", "artist_id")) == [
        (0, 1, "SO1", "AR1"),
        (1, 2, UNKNOWN_SONG_ID, UNKNOWN_ARTIST_ID),
    ]
    # The later event of another page updates the user; a user without plays is not inserted.
    assert rows(wh.table("users").select("user_id", "level")) == [(1, "paid"), (2, "free")]

    first = {name: rows(wh.table(name)) for name in star_tables()}
    assert {r.table_name: r.n for r in wh.run().after} == expected
    assert {name: rows(wh.table(name)) for name in star_tables()} == first


def test_constraints_hold_after_a_load(wh):
    fill(wh)
    wh.run()
    tables = star_tables()
    for name, table in tables.items():
        df = wh.table(name)
        if table.required:
            assert all(r.n_nulls == 0 for r in quality.null_violations(df, table.required).collect()), name
        if table.primary_key:
            assert quality.duplicate_keys(df, [table.primary_key]).count() == 0, name
        for key, parent in table.references.items():
            assert quality.orphans(df, wh.table(parent), [key], parent_unique=True).count() == 0, (name, key)
    dims = {parent: (wh.table(parent), key) for key, parent in tables["songplays"].references.items()}
    assert all(r.complete for r in quality.completeness(wh.table("songplays"), dims).collect())


def test_later_batches_go_on(wh):
    fill(wh)
    wh.run()
    wh.events(
        "2018-11-02",
        {"ts": 1999, "userId": 1, "sessionId": 1, "song": "other"},  # same second, user, session: already there
        {"ts": 9000, "userId": 4, "sessionId": 2},
        {"ts": 9000, "userId": 4, "sessionId": 2},  # copies inside a batch stay
        {"ts": 9500, "userId": None, "sessionId": 2},  # no user: cannot be a fact
    )
    wh.songs("3", {"song_id": "SO3", "title": "other"})  # too late for the stored play of that title
    wh.songs("4", {"song_id": "SO1", "title": "renamed"})  # the stored song keeps its title
    with pytest.raises(ValueError, match="1 plays without"):
        wh.run(skip_count=True)
    assert wh.run(skip_count=True, on_reject="null").rejected["songplays"] == 1
    fact = rows(wh.table("songplays").select("songplay_id", "user_id", "song_id"))
    assert fact == [(0, 1, "SO1"), (1, 2, UNKNOWN_SONG_ID), (2, 4, "SO1"), (3, 4, "SO1")]
    assert rows(wh.table("songs").select("song_id", "title"))[1:] == [("SO1", "T"), ("SO2", "U"), ("SO3", "other")]
    assert wh.table("users").count() == 3 and wh.table("time").count() == 3
    assert wh.table("songs").filter(f"song_id = '{UNKNOWN_SONG_ID}'").count() == 1


def test_later_batches_without_broadcasts(wh, shuffled_joins):
    test_later_batches_go_on(wh)


@pytest.mark.parametrize("mode, matched, unmatched", [("append", 4, 2), ("overwrite", 1, 1)])
def test_staging_twice_before_the_first_build(wh, mode, matched, unmatched):
    wh.events("a", {"ts": 1000, "userId": 1}, {"ts": 2000, "userId": 1, "song": "none"})
    wh.songs("1", {})
    for skip_dwh in (True, False):
        wh.run(staging_mode=mode, skip_dwh=skip_dwh, skip_count=True)
    assert wh.table("songplays").filter("song_id = 'SO1'").count() == matched
    assert wh.table("songplays").filter("song_id != 'SO1'").count() == unmatched
    # More staging of the same rows adds nothing to a filled fact.
    wh.run(staging_mode=mode, skip_count=True)
    assert wh.table("songplays").count() == matched + unmatched


def test_only_the_days_of_the_batch_are_read(wh, spark):
    day = 86_400_000
    wh.events("a", *[{"ts": d * day + 1000, "userId": 1, "sessionId": d} for d in range(5)])
    wh.songs("1", {})
    wh.run(skip_count=True)
    assert wh.table("songplays").columns == star_tables()["songplays"].schema.names
    known = t.load_between(spark, wh.db, "songplays", "start_time", datetime(1970, 1, 2), datetime(1970, 1, 3, 0, 0, 1))
    text = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*start_date[^\]]*1970-01-02", text)
    assert sorted(r.session_id for r in known.collect()) == [1, 2]
    assert len(known.inputFiles()) == 2


def test_ids_are_reserved_before_rows_are_written(wh, spark):
    wh.events("a", {"ts": 1000, "userId": 1, "sessionId": 1})
    wh.songs("1", {})
    wh.run(skip_count=True)
    assert t.reserve_ids(spark, wh.db, "songplays", "songplay_id", 5) == 1  # a load that then fails
    wh.events("b", {"ts": 2000, "userId": 1, "sessionId": 1})
    wh.run(skip_count=True)
    assert rows(wh.table("songplays").select("songplay_id")) == [(0,), (6,)]
    spark.sql(f"ALTER TABLE {wh.db}.songplays UNSET TBLPROPERTIES ('{t.NEXT_ID}')")
    assert t.reserve_ids(spark, wh.db, "songplays", "songplay_id", 1) == 7


def test_fact_can_be_cleared_and_rebuilt(wh, spark):
    fill(wh)
    wh.run(skip_count=True)
    before = rows(wh.table("songplays"))
    t.clear(spark, wh.db, "songplays")
    assert wh.table("songplays").count() == 0
    wh.run(skip_staging=True, skip_count=True)
    assert rows(wh.table("songplays")) == before
    with pytest.raises(ValueError):
        t.replace(wh.table("songplays"), wh.db, "songplays")


def test_load_without_plays(wh):
    wh.events("a", {"page": "Home"})
    wh.songs("1", {})
    assert {r.table_name: r.n for r in wh.run().after}["songplays"] == 0


def test_skips(wh):
    fill(wh)
    result = wh.run(skip_dwh=True, skip_count=True)
    assert result.before == result.after == []
    assert wh.counts() == {**dict.fromkeys(star_tables(), 0), "staging_events": 5, "staging_songs": 2}
    wh.run(skip_staging=True, skip_count=True)
    assert wh.table("songplays").count() == 2


def test_value_that_does_not_fit_fails_before_anything_is_stored(wh):
    fill(wh)
    wh.run(skip_dwh=True, skip_count=True)
    wh.events("bad", {"userId": "x"})
    with pytest.raises(Exception, match="userId cannot hold: x"):
        wh.run()
    assert wh.table("staging_events").count() == 5


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_values_that_do_not_fit_are_set_aside(wh, spark, mode):
    wh.events("bad", {"userId": "x", "artist": "z" * 300}, {"userId": 5})
    wh.songs("1", {})
    with pytest.raises(ValueError, match="2 values of staging_events do not fit, more than 1"):
        wh.run(on_reject="null", staging_mode=mode, max_rejects=1)
    assert wh.table("staging_events").count() == 0
    result = wh.run(on_reject="null", staging_mode=mode, max_rejects=2)
    assert {n: result.rejected[n] for n in ("staging_events", "staging_songs")} == {"staging_events": 2, "staging_songs": 0}
    assert rows(wh.table("staging_events").select("userId", "artist")) == [(None, None), (5, "A")]
    assert wh.table("staging_events").columns == star_tables()["staging_events"].schema.names
    kept = rows(wh.table("staging_rejects").select("table_name", "column_name", "raw_value", "reason", "batch"))
    assert kept == [
        ("staging_events", "artist", "z" * 300, "too long", result.batch),
        ("staging_events", "userId", "x", "not a int", result.batch),
    ]
    assert wh.table("songplays").count() == 1


def test_event_columns_may_come_from_a_paths_file(wh, spark):
    names = star_tables()["staging_events"].schema.names
    paths = [f"$['{n}']" for n in names]
    paths[names.index("userId")] = "$['user']['ids'][0]"
    write_json(wh.folder, "paths.json", {"jsonpaths": paths})
    wh.events("a", {"userId": None, "user": {"ids": [8, 9]}})
    wh.songs("1", {})
    wh.run(event_paths_file=str(wh.folder / "paths.json"), skip_count=True)
    assert rows(wh.table("users").select("user_id")) == [(8,)]
    with pytest.raises(ValueError, match="not both"):
        wh.run(event_paths_file="x", event_mapping={"a": "$.a"})


def test_command_line(wh, spark, capsys):
    wh.events("a", {"userId": "x"}, {"userId": 8})
    wh.songs("1", {})
    folder = str(wh.folder)
    assert main(["create", wh.db, f"{folder}/other"], spark) == 0
    arguments = ["load", wh.db, f"{folder}/log_data", f"{folder}/song_data", "--keep-rejects", "--max-rejects", "1"]
    assert main([*arguments, "--skip-dwh", "--skip-count"], spark) == 0
    assert "rejected: staging_events 1" in capsys.readouterr().out
    assert wh.table("staging_events").count() == 2 and wh.table("users").count() == 0
    assert main(["create", wh.db, f"{folder}/other", "--keep"], spark) == 0
    assert wh.table("staging_events").count() == 2
    assert main(["drop", wh.db], spark) == 0
    assert not spark.catalog.tableExists(f"{wh.db}.users")
    with pytest.raises(SystemExit):
        main(["load", wh.db], spark)


def test_fact_key_is_known_by_name():
    assert set(PLAY_KEY) <= set(star_tables()["songplays"].schema.names)


def staged(wh):
    return [wh.table(name).count() for name in ("staging_events", "staging_songs")]


def test_each_file_is_staged_once(wh):
    wh.events("a[1]{x}", {"ts": 1000, "userId": 1})
    wh.songs("1", {})
    options = {"staging_mode": "append", "once": True, "skip_count": True}
    first = wh.run(**options, skip_dwh=True)
    assert first.files == {"staging_events": 1, "staging_songs": 1} and staged(wh) == [1, 1]
    again = wh.run(**options, skip_dwh=True)
    assert again.files == {"staging_events": 0, "staging_songs": 0} and staged(wh) == [1, 1]
    assert again.undone == []
    wh.events("b", {"ts": 2000, "userId": 1}, {"ts": 3000, "userId": 2})
    assert wh.run(**options, skip_dwh=True).files == {"staging_events": 1, "staging_songs": 0}
    assert staged(wh) == [3, 1]
    wh.events("b", {"ts": 2000, "userId": 1}, {"ts": 3000, "userId": 2}, {"ts": 4000, "userId": 2})  # another file now
    assert wh.run(**options).files == {"staging_events": 1, "staging_songs": 0}
    assert staged(wh) == [6, 1] and wh.table("songplays").count() == 6  # copies of one build stay
    with pytest.raises(ValueError, match="append mode only"):
        wh.run(once=True)


@pytest.mark.parametrize("crash_at, on_reject", [("staging_events", "fail"), ("staging_songs", "null")])
def test_a_load_that_died_is_undone_and_done_again(wh, spark, monkeypatch, on_reject, crash_at):
    options = {"staging_mode": "append", "once": True, "skip_count": True, "skip_dwh": True, "on_reject": on_reject}
    wh.events("a", {"ts": 1000, "userId": 1})
    wh.songs("1", {})
    wh.run(**options)
    bad = {"registration": "r" * 300} if on_reject == "null" else {}
    wh.events("b", {"ts": 2000, "userId": 2, **bad}, {"ts": 3000, "userId": 2})
    wh.songs("2", {"song_id": "SO2", "title": "t" * 300 if on_reject == "null" else "U"})

    note = Ledger.note

    def crash(self, batch, name, step):  # all rows are written, the ledger does not say so yet
        if name == crash_at and step == "stored":
            raise KeyboardInterrupt
        note(self, batch, name, step)

    with monkeypatch.context() as broken, pytest.raises(KeyboardInterrupt):
        broken.setattr(Ledger, "note", crash)
        wh.run(**options)
    left = [3, 1] if crash_at == "staging_events" else [3, 2]
    assert staged(wh) == left

    result = wh.run(**options)
    assert [name for _, name in result.undone] == [crash_at]
    assert result.files == {"staging_events": int(crash_at == "staging_events"), "staging_songs": 1}
    assert staged(wh) == [3, 2]
    if on_reject == "null":
        kept = rows(wh.table("staging_rejects").select("table_name", "column_name"))
        assert kept == [("staging_events", "registration"), ("staging_songs", "title")]
    assert wh.run(**options).undone == [] and staged(wh) == [3, 2]


def test_files_of_the_fact_follow_its_bytes(wh, spark):
    hour = 3_600_000

    def load_day(day, n):  # every play differs, so that its bytes do too
        texts = [f"{day}-{k}-{hash((day, k)) & 0xFFFFFFFF:x}" * 4 for k in range(n)]
        wh.events(f"d{day}", *[{"ts": day * 24 * hour + k * 1000, "userId": k, "sessionId": k, "userAgent": t} for k, t in enumerate(texts)])
        wh.run(skip_count=True, file_bytes=8_000)
        files = spark.table(f"{wh.db}.songplays").filter(f"start_date = date_add(date'1970-01-01', {day})")
        return files.select("start_time", F.input_file_name().alias("file")).groupBy("file").agg(F.min("start_time").alias("low"), F.max("start_time").alias("high")).orderBy("low").collect()

    wh.songs("1", {})
    small = load_day(1, 1000)
    (wh.folder / "log_data/2018/11/d1.json").unlink()
    large = load_day(2, 2000)
    assert 3 <= len(small) and 1.6 * len(small) <= len(large) <= 2.4 * len(small)
    assert all(a.high <= b.low for a, b in zip(large, large[1:]))
    assert t.files_for(0) == t.files_for(1) == 1 and t.files_for(2 * t.FILE_BYTES + 1) == 3
