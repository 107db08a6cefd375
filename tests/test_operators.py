from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.operators import dimensions as d
from starloom.operators import bitmap, facts, filters, incremental, quality, references, star
from starloom.operators.surrogate_keys import assign_ids
from starloom.operators.references import Reference
from starloom.operators.upsert import changed_members, packed_order, update_users, upsert_latest, users_with_updates
from starloom.schemas import UNKNOWN_ARTIST, UNKNOWN_ARTIST_ID, UNKNOWN_SONG, UNKNOWN_SONG_ID
from starloom.sources.tables import lay_out
from tests.conftest import rows


def ids(df, column="k"):
    return sorted(r[column] for r in df.collect())


# --- filters -------------------------------------------------------------------------------------------------------


def test_filters(spark):
    df = spark.createDataFrame([("NextSong", "SO1"), ("Home", "SO2"), (None, "XX"), ("NextSong", None)], "page string, s string")
    assert rows(filters.plays_only(df)) == [("NextSong", None), ("NextSong", "SO1")]
    assert rows(filters.with_prefix(df, "s", "SO").select("s")) == [("SO1",), ("SO2",)]
    assert rows(filters.without_prefix(df, "s", "SO").select("s")) == [("XX",)]
    assert rows(filters.value_in(df, "page", ["Home", "About"])) == [("Home", "SO2")]
    assert filters.preview(df, 2).count() == 2
    assert [r.s for r in filters.preview(df.dropna(subset=["s"]), 2, ["s"]).collect()] == ["SO1", "SO2"]


# --- insert-if-absent ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("target", [[], [(1,)]])
def test_null_keys_are_rejected_and_counted(spark, target):
    source = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    seen = spark.createDataFrame(target, "k int")
    assert ids(incremental.new_keys_only(source, seen, ["k"])) == ([2] if target else [1, 2])
    assert incremental.null_key_count(source, ["k"]).first().n_rejected == 1


def test_duplicates_inside_a_batch_stay(spark):
    source = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    seen = spark.createDataFrame([(2, "b"), (2, "b")], "k int, v string")
    assert rows(incremental.new_keys_only(source, seen, ["k", "v"])) == [(1, "a"), (1, "a")]


@settings(max_examples=15, deadline=None)
@given(
    source=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), max_size=25),
    seen=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), max_size=8),
)
def test_new_keys_equal_not_in(spark, source, seen):
    s = spark.createDataFrame(source, "a int, b int")
    t = spark.createDataFrame(seen, "a int, b int")
    expected = sorted(r for r in source if r not in set(seen))
    for limit in ("10485760b", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert sorted(tuple(r) for r in incremental.new_keys_only(s, t, ["a", "b"], hot_rows=3).collect()) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760b")


def test_a_bitmap_rules_out_most_of_a_large_target(spark, shuffled_joins, tmp_path):
    spark.range(0, 400_000, 1, 4).selectExpr("id AS k", "concat('s', id) AS t").write.parquet(str(tmp_path / "big"))
    target = spark.read.parquet(str(tmp_path / "big"))
    batch = [(k, f"s{k}") for k in (5, 5, 399_999, 400_001)] + [(None, "s1"), (7, "other")]
    source = spark.createDataFrame(batch, "k bigint, t string")
    keys = ["k", "t"]
    plain = rows(incremental.new_keys_only(source, target, keys))
    assert plain == rows(incremental.new_keys_only(source, target, keys, prune_target=True)) == [(400_001, "s400001"), (7, "other")]
    left = bitmap.maybe_in(target, keys, bitmap.key_bitmap(source.dropna(), keys))
    assert left.columns == target.columns and 2 <= left.count() < 0.05 * 400_000
    assert bitmap.maybe_in(target, keys, bitmap.key_bitmap(source.limit(0), keys)).count() == 0
    plan = incremental.new_keys_only(source, target, keys, prune_target=True)._jdf.queryExecution().executedPlan().toString()
    at = plan.index("FileScan parquet")
    assert "BroadcastHashJoin" in plan[:at] and "bit_or" in plan


def test_range_pruning_keeps_all_candidates(spark):
    target = spark.createDataFrame([(1,), (3,), (5,), (7,)], "k int")
    source = spark.createDataFrame([(3,), (6,), (None,)], "k int")
    assert ids(incremental.within_range_of(target, source, "k")) == [3, 5]
    assert ids(incremental.within_range_of(target, source.limit(0), "k")) == []


def test_least_values_are_taken_column_by_column(spark):
    df = spark.createDataFrame([(1, "b", "x"), (1, "a", "y"), (2, None, "z"), (2, "a", None)], "k int, p string, q string")
    assert rows(incremental.first_version(df, "k", {"p": "p", "q": "q"})) == [(1, "a", "x"), (2, "a", "z")]


def test_only_absent_members_are_new(spark):
    dim = spark.createDataFrame([(1, "old")], "k int, v string")
    source = spark.createDataFrame([(1, "new"), (2, "new"), (None, "new")], "k int, v string")
    assert rows(incremental.absent_members(dim, source, "k")) == [(2, "new")]


def test_unknown_member_exactly_once(spark):
    schema = "song_id string, title string, artist_id string, year int, duration decimal(12,4)"
    empty = spark.createDataFrame([], schema)
    once = incremental.ensure_member(empty, UNKNOWN_SONG, "song_id")
    twice = incremental.ensure_member(once, UNKNOWN_SONG, "song_id")
    assert rows(once) == rows(twice) == [(UNKNOWN_SONG_ID, "***Unknown Song***", UNKNOWN_ARTIST_ID, None, None)]
    assert once.schema == twice.schema
    artists = spark.createDataFrame([], "artist_id string, name string")
    assert rows(incremental.ensure_member(artists, UNKNOWN_ARTIST, "artist_id")) == [
        (UNKNOWN_ARTIST_ID, "*** Unknown Artist ***")
    ]


# --- dimensions and upsert -----------------------------------------------------------------------------------------


def test_dimensions_from_staging(spark):
    songs = spark.createDataFrame(
        [
            ("AR1", "n", "l", Decimal("1.5"), None, "SO1", "t", 1999, Decimal("3.25")),
            ("AR1", "m", None, None, Decimal("2.5"), "SO1", "s", 2001, Decimal("4.25")),
            (None, "x", None, None, None, "SO2", "u", 0, None),
            ("AR3", "y", None, None, None, None, "v", 0, None),
        ],
        "artist_id string, artist_name string, artist_location string, artist_latitude decimal(20,6),"
        "artist_longitude decimal(20,6), song_id string, title string, year int, duration decimal(12,4)",
    )
    assert [(r.song_id, r.title, r.artist_id, r.year) for r in d.songs_from(songs).orderBy("song_id").collect()] == [
        ("SO1", "s", "AR1", 1999),
        ("SO2", "u", None, 0),
    ]
    assert [(r.artist_id, r.name, r.location) for r in d.artists_from(songs).orderBy("artist_id").collect()] == [
        ("AR1", "m", "l"),
        ("AR3", "y", None),
    ]


def test_time_has_one_row_per_second(spark):
    events = spark.createDataFrame([(1000, "NextSong"), (1999, "NextSong"), (2000, "Home"), (None, "NextSong")], "ts long, page string")
    assert [r.start_time for r in d.time_from(events).collect()] == [datetime(1970, 1, 1, 0, 0, 1)]


def upsert(dim, source):
    return upsert_latest(dim, source, "uid", "k", {"level": "lv"}, ["ts", "tie"])


def test_upsert_takes_the_latest_row(spark):
    dim = spark.createDataFrame([(1, "free"), (2, "free"), (3, "free")], "k int, level string")
    source = spark.createDataFrame(
        [
            (1, "a", 1, 9),
            (1, "c", 5, 1),
            (1, "b", 5, 2),  # same time, greater tie
            (2, "paid", 1, 1),
            (2, None, 2, 1),  # latest value is NULL
            (4, "paid", 9, 9),  # never inserted
            (None, "paid", 9, 9),
        ],
        "uid int, lv string, ts int, tie int",
    )
    after = upsert(dim, source)
    assert rows(after) == [(1, "b"), (2, "free"), (3, "free")]
    assert after.columns == dim.columns
    assert rows(changed_members(dim, after, "k", ["level"])) == [(1, "b")]


def test_upsert_winner_does_not_depend_on_row_order(spark):
    dim = spark.createDataFrame([(1, "free")], "k int, level string")
    data = [(1, "a", 5, 1), (1, "b", 5, 1)]
    for order in (data, data[::-1]):
        assert rows(upsert(dim, spark.createDataFrame(order, "uid int, lv string, ts int, tie int"))) == [(1, "b")]


def test_packed_order_sorts_as_the_columns_do(spark):
    values = [None, -(2**31), -1, 0, 7, 2**31 - 1]
    data = [(a, b, c) for a in (None, -5, 0, 1541106106796) for b in values for c in values]
    df = spark.createDataFrame(data, "ts long, s int, i int")
    found = df.select("ts", "s", "i", packed_order(df, ["ts", "s", "i"]).alias("p")).collect()

    def key(r):
        return tuple((v is not None, v or 0) for v in (r.ts, r.s, r.i))

    assert [key(r) for r in sorted(found, key=lambda r: r.p)] == sorted(map(key, found))
    assert len({r.p for r in found}) == len(data)
    assert packed_order(df.withColumn("i", F.col("i").cast("string")), ["ts", "i"]) is None
    assert packed_order(df.select("ts", F.col("ts").alias("u"), F.col("ts").alias("v")), ["ts", "u", "v"]) is None


def test_an_order_that_cannot_be_packed_still_decides(spark):
    dim = spark.createDataFrame([(1, "free")], "k int, level string")
    source = spark.createDataFrame([(1, "a", "x", 1), (1, "b", "y", 0)], "uid int, lv string, ts string, tie int")
    assert rows(upsert(dim, source)) == [(1, "b")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("ab"), st.sampled_from(["x", "y", None]), st.integers(0, 4), st.booleans()), max_size=20))
def test_users_in_one_pass_equal_insert_and_update(spark, events):
    data = [(u or None, f, f, g, f, t, k, "NextSong" if p else "Home") for k, (u, f, g, t, p) in enumerate(events)]
    df = spark.createDataFrame(data, "userid int, firstname string, lastname string, gender string, level string, ts long, tie int, page string")
    order = ["ts", "tie"]
    assert rows(users_with_updates(df, order)) == rows(update_users(d.users_from(df), df, order))


# --- facts ---------------------------------------------------------------------------------------------------------

EVENT = "artist string, song string, level string, page string, sessionid int, ts long, userid int, location string, useragent string"


def fact_of(spark, songs, events=((None, None), ("A", "T"), ("A", "U"))):
    data = [(a, s, "free", "NextSong", 1, 1000 * i, 7, None, "ua") for i, (a, s) in enumerate(events)]
    plays = filters.select_play_columns(spark.createDataFrame(data, EVENT))
    catalogue = spark.createDataFrame(songs, "artist_name string, title string, song_id string, artist_id string")
    return plays, catalogue


@pytest.mark.parametrize("limit", ["10485760b", "-1"])
def test_fact_resolution(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        plays, catalogue = fact_of(
            spark, [("A", "T", "SO1", "AR1"), ("A", "T", "SO2", None), (None, None, "SO3", "AR3"), ("B", "U", "SO4", "AR4")]
        )
        got = rows(facts.resolve_songs(plays, catalogue).select("song_id", "artist_id"))
        assert got == [
            (UNKNOWN_SONG_ID, UNKNOWN_ARTIST_ID),
            (UNKNOWN_SONG_ID, UNKNOWN_ARTIST_ID),
            ("SO1", "AR1"),
            ("SO2", UNKNOWN_ARTIST_ID),  # known song, unknown artist
        ]
        got = rows(facts.resolve_with_source_text(plays, catalogue).select("song_id", "artist_id"))
        assert got == [(None, None), ("SO1", "AR1"), ("SO2", "A"), ("U", "A")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760b")


def test_loose_resolution_pairs_independently(spark):
    plays, _ = fact_of(spark, [])
    artists = spark.createDataFrame([("AR1", "A"), ("AR2", "A")], "artist_id string, name string")
    songs = spark.createDataFrame([("SO9", "U")], "song_id string, title string")
    got = rows(facts.resolve_loose(plays, artists, songs).select("dummy", "song_id", "artist_id"))
    assert got == [
        (9999, None, None),
        (9999, "SO9", "AR1"),
        (9999, "SO9", "AR2"),
        (9999, "T", "AR1"),
        (9999, "T", "AR2"),
    ]


# --- keys and layout -----------------------------------------------------------------------------------------------


def test_ids_are_dense_and_ordered(spark):
    df = spark.range(0, 500, 1, 7).select((F.col("id") * 37 % 500).alias("v"), F.lit(None).cast("int").alias("empty"))
    got = assign_ids(df, ["v"], "id", start=10, n_partitions=5).orderBy("id").collect()
    assert [r.id for r in got] == list(range(10, 510))
    assert [r.v for r in got] == list(range(500))


def test_ids_of_nothing(spark):
    assert assign_ids(spark.range(0).toDF("v"), ["v"], "id").collect() == []


def test_ids_with_one_hot_value(spark):
    df = spark.range(0, 300, 1, 4).select((F.col("id") % 3 == 0).cast("int").alias("a"), F.col("id").alias("b"))
    got = assign_ids(df, ["a", "b"], "id", n_partitions=6).orderBy("id").collect()
    assert [r.id for r in got] == list(range(300))
    assert [(r.a, r.b) for r in got] == sorted((int(i % 3 == 0), i) for i in range(300))


@pytest.mark.parametrize("cuts_from", [None, ["a"], ["a", "b"]])
def test_ids_follow_every_order_column(spark, cuts_from):
    data = [(k * 7 % 11 if k % 5 else None, f"s{k * 13 % 17}", datetime(2020, 1, 1 + k % 3), k) for k in range(400)]
    df = spark.createDataFrame(data, "a int, b string, c timestamp_ntz, d int").repartition(5)
    keys = None if cuts_from is None else df.select(*cuts_from)
    got = assign_ids(df, ["a", "b", "c", "d"], "id", n_partitions=9, cuts_from=keys).orderBy("id").collect()
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    assert [tuple(r) for r in got] == [(k, *r) for k, r in enumerate(want)]


def test_ids_are_cut_into_many_ranges(spark):
    df = spark.range(0, 5000, 1, 7).select(F.col("id").alias("v"))
    plan = assign_ids(df, ["v"], "id", n_partitions=40)
    ranges = plan.select(F.spark_partition_id().alias("p")).distinct().count()
    assert ranges >= 1 and rows(plan.select("id", "v")) == sorted(((k, k) for k in range(5000)), key=lambda t: tuple(map(str, t)))
    with pytest.raises(ValueError):
        assign_ids(df.withColumn("w", F.lit(1)), ["v", "w"], "id", cuts_from=df.withColumnRenamed("v", "w"))


def test_the_first_id_may_depend_on_the_number_of_rows(spark):
    df = spark.range(0, 30, 1, 3).toDF("v")
    assert rows(assign_ids(df, ["v"], "id", start=lambda n: 100 * n).agg(F.min("id"), F.max("id"))) == [(3000, 3029)]


def test_sorted_layout(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") % 2).alias("a"), F.col("id").alias("b"))
    spans = lay_out(df, ["a", "b"], 4).groupBy(F.spark_partition_id().alias("p")).agg(
        F.min(F.struct("a", "b")).alias("lo"), F.max(F.struct("a", "b")).alias("hi"), F.count("*").alias("n")
    ).orderBy("p").collect()
    assert len(spans) == 4 and max(s.n for s in spans) < 2 * 250
    assert all(x.hi < y.lo for x, y in zip(spans, spans[1:]))


# --- checks and reports --------------------------------------------------------------------------------------------


def test_checks(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, None)], "k int, v string")
    assert rows(quality.null_violations(df, ["k", "v"])) == [("k", 1), ("v", 2)]
    assert rows(quality.duplicate_keys(df.dropna(subset=["k"]), ["k"])) == [(1, 2)]
    child = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "z")], "a int, b string")
    parent = spark.createDataFrame([(1,)], "k int")
    assert rows(quality.orphans(child, parent, {"a": "k"})) == [(2,)]
    assert rows(quality.orphans(child.withColumnRenamed("a", "k"), parent, ["k"])) == [(2,)]


def test_completeness(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a")], "k int, s string")
    dims = {
        "k": (spark.createDataFrame([(1,)], "k int"), "k"),
        "s": (spark.createDataFrame([("a",), ("b",)], "s string"), "s"),
        "dup": (spark.createDataFrame([("a",), ("a",), ("b",)], "s string"), "s"),
    }
    assert rows(quality.completeness(fact, dims)) == [("dup", 4, 7, False), ("k", 4, 2, False), ("s", 4, 4, True)]


def reference_case(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "x"), (None, "x"), (7, None)], "k int, s string")
    other = spark.createDataFrame([("a",), ("z",), ("z",)], "t string")
    parents = {
        "ks": (spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int"), "k"),
        "ss": (spark.createDataFrame([("a",), ("b",)], "s string"), "s"),
    }
    return {"fact": fact, "other": other}, parents, [Reference("fact", "k", "ks"), Reference("fact", "s", "ss"), Reference("other", "t", "ss")]


@pytest.mark.parametrize("limit", ["10485760b", "-1"])
def test_references_are_checked_in_one_pass(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        children, parents, refs = reference_case(spark)
        assert rows(references.foreign_keys(children, parents, refs)) == [
            ("fact", "k", "ks", 4, 3, 2, 1, 1),
            ("fact", "s", "ss", 5, 3, 1, 2, 1),
            ("other", "t", "ss", 3, 2, 0, 2, 1),
        ]
        assert rows(references.orphan_keys(children, parents, refs)) == [("fact", "k", "7", 1), ("fact", "s", "x", 2), ("other", "t", "z", 2)]
        empty = {name: frame.limit(0) for name, frame in children.items()}
        assert rows(references.foreign_keys(empty, parents, refs)) == [
            ("fact", "k", "ks", 0, 0, 0, 0, 0), ("fact", "s", "ss", 0, 0, 0, 0, 0), ("other", "t", "ss", 0, 0, 0, 0, 0)
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760b")


def test_the_fact_is_scanned_once_for_all_references(spark, tmp_path):
    children, parents, refs = reference_case(spark)
    children["fact"].write.parquet(str(tmp_path / "fact"))
    stored = {**children, "fact": spark.read.parquet(str(tmp_path / "fact"))}
    plan = references.foreign_keys(stored, parents, refs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_primary_keys(spark):
    tables = {
        "unique": (spark.createDataFrame([(1,), (2,), (None,)], "k int"), "k"),
        "twice": (spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "s string"), "s"),
        "none": (spark.createDataFrame([], "t timestamp_ntz"), "t"),
    }
    assert rows(references.primary_keys(tables)) == [("none", "t", 0, 0, 0, 0), ("twice", "s", 6, 2, 2, 1), ("unique", "k", 3, 1, 2, 0)]


def test_declared_references():
    from starloom.schemas import star_tables

    assert {(r.table, r.column, r.parent) for r in references.declared(star_tables())} == {
        ("songs", "artist_id", "artists"),
        ("songplays", "start_time", "time"),
        ("songplays", "user_id", "users"),
        ("songplays", "song_id", "songs"),
        ("songplays", "artist_id", "artists"),
    }


def test_referential_count_equals_counting_the_join(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    assert star.referential_count(fact, dim, "k").first().n == fact.join(dim, "k").count() == 4
    assert star.referential_count(fact.limit(0), dim, "k").first().n == 0


@pytest.mark.parametrize("limit", ["10485760b", "-1"])
def test_star_reports(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        fact = spark.createDataFrame(
            [(1, 7, "SO1"), (1, 7, UNKNOWN_SONG_ID), (2, 8, "SO1"), (3, 7, "SO2"), (9, 7, "SO2")], "t int, u int, song_id string"
        )
        time = spark.createDataFrame([(1, 2018, 5), (2, 2018, 5), (3, 2017, 6)], "t int, year int, week int")
        users = spark.createDataFrame([(7, "paid"), (8, "free")], "u int, level string")
        by_week = star.plays_by(fact, {"t": time}, ["year", "week"]).collect()
        assert [tuple(r) for r in by_week] == [(2017, 6, 1), (2018, 5, 3)]
        by_level = star.plays_by(fact, {"t": time, "u": users}, ["year", "week", "level"]).collect()
        assert [tuple(r) for r in by_level] == [(2017, 6, "paid", 1), (2018, 5, "free", 1), (2018, 5, "paid", 2)]
        assert rows(star.match_rate(fact)) == [("Known", 4), ("Unknown", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760b")


def test_songs_with_artists_and_top_k(spark):
    songs = spark.createDataFrame([("SO2", "t", "AR1", 1), ("SO1", "u", "AR9", 2)], "song_id string, title string, artist_id string, year int")
    artists = spark.createDataFrame([("AR1", "n", "l")], "artist_id string, name string, location string")
    assert rows(star.songs_with_artists(songs, artists)) == [("SO2", "t", 1, "AR1", "n")]
    assert [r.song_id for r in star.top_k(songs, ["song_id"], 1).collect()] == ["SO1"]


def test_count_tables(spark):
    tables = {"a": spark.range(3), "b": spark.range(0)}
    assert rows(star.count_tables(tables, "Before")) == [("Before", "a", 3), ("Before", "b", 0)]
    assert star.count_tables(tables).columns == ["table_name", "n"]
