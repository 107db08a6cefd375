"""Every registered query against its SQL counterpart, and the shape of every plan."""

import re

import duckdb
import pytest

import __spark_entry__ as driver
from starloom.plans.catalog import QUERIES
from starloom.plans.oracle import ORACLE
from tests.conftest import SF_DIR

TABLES = ["events", "part", "customer"]
NAMES = sorted(QUERIES)

# Queries that together hold every join, planned once more as if no side were small.
LARGE = ["songplays_incremental", "loose_preview", "plays_by_week_level", "songs_artists", "users_changed", "dq_orphans"]
# Queries whose aggregates over whole tables must not sort scanned rows.
HASHED = ["users_dim", "users_upsert", "users_changed", "songs_dim", "artists_dim", "dq_required", "plays_by_week_level", "loose_preview"]

# Rows at scale factor 0.001 (FIXTURES.md, part C).
ROWS = {
    "stage_events": 1000,
    "stage_songs": 200,
    "plays_only": 188,
    "songplays_full": 193,
    "like_song": 34,
    "like_artist": 34,
    "not_like_song": 159,
    "songplays_incremental": 95,
    "time_dim": 188,
    "time_incremental": 95,
    "users_dim": 15,
    "users_incremental": 10,
    "users_changed": 6,
    "users_upsert": 15,
    "songs_dim": 201,
    "songs_incremental": 193,
    "artists_dim": 51,
    "artists_incremental": 44,
    "songs_artists": 201,
    "known_unknown": 2,
    "plays_by_week": 5,
    "plays_by_week_level": 10,
    "plays_by_week_gender": 20,
    "loose_preview": 935,
    "count_tables": 7,
    "in_list": 398,
    "case_decode": 5,
    "epoch_to_timestamp": 999,
    "songplays_fallback": 193,
    "ensure_member_idempotent": 201,
    "topk_songs": 5,
    "preview_songplays": 10,
    "songplays_keyed": 193,
    "dq_nulls": 14,
    "dq_duplicates": 18,
    "dq_orphans": 6,
    "completeness": 4,
    "count_joins": 4,
    "dq_foreign_keys": 5,
    "dq_primary_keys": 5,
    "stage_events_json": 1000,
    "stage_songs_json": 200,
    "load_accepted": 1000,
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def as_text(rows):
    return sorted(repr(tuple(r)) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = df.select(*columns).collect()
    assert len(found) == ROWS.get(name, len(found)) and found
    if name in driver.oracle_sql():
        listed = ", ".join(f'"{c}"' for c in columns)
        expected = duck.sql(f"SELECT {listed} FROM ({driver.oracle_sql()[name]})")
        assert sorted(duck.sql(driver.oracle_sql()[name]).columns) == columns
        assert as_text(found) == as_text(expected.fetchall())


@pytest.mark.parametrize("name", LARGE)
def test_query_without_broadcasts(spark, duck, name, shuffled_joins):
    test_query(spark, duck, name)


def test_only_engine_dependent_queries_lack_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_flagship_counts_and_order(spark):
    found = [tuple(r) for r in driver.entry(spark).collect()]
    assert found == [(2024, 1, w, n) for w, n in zip(range(1, 6), [45, 48, 40, 46, 14])]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", ["10485760b", "-1"])
def test_plans(spark, limit):
    """No nested-loop or cross join, no unpartitioned window, no Python in any plan; one task only after partial sums."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        for name in NAMES if limit != "-1" else LARGE:
            text = plan(driver.queries()[name](spark, SF_DIR))
            for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "MapInPandas"):
                assert node not in text, (name, node)
            for window in re.findall(r"Window \[[^\n]*", text):
                assert re.search(r"\], \[_*\w+#\d+\], \[", window), (name, window)
            for after in re.findall(r"Exchange SinglePartition[^\n]*\n([^\n]*)", text):
                assert "partial_" in after, (name, after)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760b")


@pytest.mark.parametrize("name", HASHED)
def test_scanned_rows_are_hashed_not_sorted(spark, name):
    """Below every partial SortAggregate stands a HashAggregate, above whatever is scanned."""
    lines = plan(driver.queries()[name](spark, SF_DIR)).split("\n")
    assert any("HashAggregate" in line for line in lines)
    for at, line in enumerate(lines):
        if "SortAggregate" in line:
            below = next(x for x in lines[at + 1 :] if "HashAggregate" in x or "FileScan" in x)
            assert "HashAggregate" in below, (name, line)


@pytest.mark.parametrize("name, most", [("completeness", 7), ("count_joins", 7), ("dq_foreign_keys", 8), ("count_tables", 9), ("plays_by_week_level", 6)])
def test_tables_are_scanned_few_times(spark, name, most):
    assert plan(driver.queries()[name](spark, SF_DIR)).count("FileScan parquet") <= most


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(driver.queries()["plays_by_week"](spark, SF_DIR))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\n]*?)\], ReadSchema", text)
    events = [(c, f) for c, f in scans if "event_type" in c]
    assert events
    for columns, filters in events:
        assert "EqualTo(event_type,view)" in filters
        assert "props" not in columns and "value" not in columns
    assert "StringStartsWith" in plan(
        spark.read.parquet(f"{SF_DIR}/part.parquet").filter("startswith(p_name, 'SO')")
    )


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(driver.queries()["topk_songs"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan(driver.queries()["preview_songplays"](spark, SF_DIR))


def test_hot_fact_keys_are_counted_before_the_shuffle(spark):
    """The unknown song holds most fact rows; what is shuffled for its join is one count per task."""
    text = plan(driver.queries()["count_fact_songs"](spark, SF_DIR))
    exchange = re.search(r"Exchange hashpartitioning\(song_id[^\n]*\n([^\n]*)", text)
    assert exchange and "partial_count" in exchange.group(1)


def test_song_names_are_not_broadcast(spark):
    """The names grow with the events; no broadcast of them, whatever the estimate of their files says."""
    text = plan(driver.queries()["songplays_keyed"](spark, SF_DIR))
    joins = re.findall(r"(\w+Join) \[event_id#\d+L?\], \[event_id#\d+L?\]", text)
    assert joins and "BroadcastHashJoin" not in joins, joins
