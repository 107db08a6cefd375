import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from starloom.schemas import STAGING_EVENTS, star_tables
from starloom.sources import json_files as j
from starloom.sources import tables as t
from tests.conftest import rows

EVENT = {
    "artist": "A",
    "auth": "Logged In",
    "firstName": "Ann",
    "gender": "F",
    "itemInSession": 3,
    "lastName": "Lee",
    "length": 243.5,
    "level": "free",
    "location": "X, Y",
    "method": "PUT",
    "page": "NextSong",
    "registration": 1.540919166796e12,
    "sessionId": 139,
    "song": "T",
    "status": 200,
    "ts": 1541106106796,
    "userAgent": "ua",
    "userId": "39",
}


def write_json(folder, name, *objects):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(o if isinstance(o, str) else json.dumps(o) for o in objects))
    return path


def test_events_by_path(spark, tmp_path):
    text = json.dumps(EVENT).replace("1540919166796.0", "1.540919166796E12")
    write_json(tmp_path, "log/2018/11/a.json", text, {"page": "Home", "userId": ""})
    df = j.read_events(spark, str(tmp_path / "log"))
    assert df.schema.names == STAGING_EVENTS.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in STAGING_EVENTS]
    first, second = sorted(df.collect(), key=lambda r: r.page, reverse=True)
    assert (first.userId, first.ts, first.status, first.registration) == (39, 1541106106796, "200", "1.540919166796E12")
    assert first.length == Decimal("244") and first.userAgent == "ua"
    assert second.userId is None and second.artist is None


def test_mapping_by_position_and_nested_paths(spark, tmp_path):
    write_json(tmp_path, "paths.json", '{\n "jsonpaths": [\n "$[\'a\'][\'b\']",\n "$.c"\n ]\n}')
    write_json(tmp_path, "d/x.json", {"a": {"b": 5}, "c": "7", "ignored": 1})
    schema = StructType([StructField("x", IntegerType()), StructField("y", IntegerType())])
    mapping = j.by_position(j.read_paths_file(spark, str(tmp_path / "paths.json")), schema)
    assert rows(j.read_events(spark, str(tmp_path / "d"), mapping, schema)) == [(5, 7)]
    with pytest.raises(ValueError):
        j.by_position(["$.a"], schema)


@pytest.mark.parametrize("path", ["a", "$", "$[0]", "$['a'].", "x$.a", "$.a[-1]", "$.a[x]"])
def test_unsupported_paths(path):
    with pytest.raises(ValueError):
        j.path_steps(path)


def test_songs_by_name(spark, tmp_path):
    song = {"num_songs": 1, "artist_id": "AR1", "artist_latitude": 35.14968, "artist_longitude": None, "duration": 218.93179}
    write_json(tmp_path, "s/A/A/1.json", {**song, "song_id": "SO1", "year": "1999", "Title": "wrong case"})
    first = j.read_songs(spark, str(tmp_path / "s")).first()
    assert (first.duration, first.artist_latitude, first.year) == (Decimal("218.9318"), Decimal("35.149680"), 1999)
    assert first.title is None and first.artist_longitude is None
    assert j.read_songs(spark, str(tmp_path / "s"), star_tables(2)["staging_songs"].schema).first().duration == Decimal("218.93")


def test_broken_json_fails_the_read(spark, tmp_path):
    write_json(tmp_path, "b/x.json", '{"page": "NextSong"', '{"page": ')
    with pytest.raises(Exception, match="Malformed"):
        j.read_events(spark, str(tmp_path / "b")).collect()


def test_rejects_are_kept_with_their_reason(spark, tmp_path):
    write_json(tmp_path, "r/x.json", *[{**EVENT, "userId": u} for u in ("39", "", 39, "x")], {"artist": "z" * 257, "ts": "y"})
    text = j.read_text_columns(spark, str(tmp_path / "r"), j.by_position(j.EVENT_PATHS, STAGING_EVENTS))
    found = j.with_rejects(text, STAGING_EVENTS)
    assert rows(j.rejected_values(found)) == [
        ("artist", "z" * 257, "too long"),
        ("ts", "y", "not a bigint"),
        ("userId", "x", "not a int"),
    ]
    assert sorted(str(r.userId) for r in found.collect()) == ["39", "39", "None", "None", "None"]
    assert sorted(len(r.rejects) for r in found.collect()) == [0, 0, 0, 1, 2]
    assert found.filter("size(rejects) = 2").first().artist is None


DOCUMENTS = [
    '{"a": {"b": [10, {"c": "x"}]}, "d": 1.50, "e": [[1], [2, 3]]}',
    '{"a": {"b": [11]}, "d": "text", "f": null}',
    '{"a": {"b": []}, "e": []}',
    '{"a": null}',
    "{}",
    '{"a": {"b": [1]}, "d": 2',
    "not json",
    "",
    None,
    '{"a": [1], "d": 3}',
]


def test_paths_go_through_objects_and_arrays(spark):
    paths = {"first": "$['a']['b'][0]", "second": "$.a.b[1]", "d": "$.d", "deep": "$.e[1][0]"}
    df = spark.createDataFrame(list(enumerate(DOCUMENTS)), "id int, doc string")
    found = {r.id: tuple(r)[1:] for r in j.parse_text_columns(df, "doc", paths, ["id"]).collect()}
    assert found[0][:2] == ("10", '{"c":"x"}') and found[0][3:] == ("2", None) and float(found[0][2]) == 1.5
    assert found[1] == ("11", None, "text", None, None)
    assert found[2] == found[3] == found[4] == (None, None, None, None, None)
    assert found[8] == (None,) * 5
    for broken in (5, 6, 9):
        assert found[broken] == (None, None, None, None, DOCUMENTS[broken])


def test_paths_must_agree_on_what_a_value_is(spark):
    df = spark.createDataFrame([("{}",)], "doc string")
    for paths in ({"x": "$.a", "y": "$.a.b"}, {"x": "$.a[0]", "y": "$.a.b"}, {"x": "$.a[0]", "y": "$.a"}):
        with pytest.raises(ValueError):
            j.parse_text_columns(df, "doc", paths)
    with pytest.raises(ValueError, match="corrupt"):
        j.parse_text_columns(df, "doc", {"x": "$.corrupt_record"})
    assert j.path_schema({"x": "$.a.b[0]", "y": "$.a.c", "z": "$.a.c"}).simpleString() == "struct<a:struct<b:array<string>,c:string>>"


def test_files_are_read_by_paths_with_arrays(spark, tmp_path):
    write_json(tmp_path, "n/x.json", {"a": {"b": [5, 6]}, "c": [{"d": "z"}]})
    found = j.read_text_columns(spark, str(tmp_path / "n"), {"one": "$.a.b[1]", "two": "$.c[0].d", "none": "$.a.b[7]"})
    assert rows(found) == [("6", "z", None)]


def test_prefix_and_nested_folders(spark, tmp_path):
    for name in ("log/2018/11/2018-11-01.json", "log/2018/11/2018-11-02.json", "log/2018/11/2018-11-10.json"):
        write_json(tmp_path, name, {"page": "NextSong"})
    assert j.read_events(spark, str(tmp_path / "log")).count() == 3
    assert j.read_events(spark, str(tmp_path / "log/2018/11/2018-11-0")).count() == 2
    assert j.read_events(spark, f"{tmp_path}/log/2018/*/2018-11-1*").count() == 1


# --- catalog tables ------------------------------------------------------------------------------------------------


@pytest.fixture
def database(spark, tmp_path):
    name = "db_" + tmp_path.name.replace("-", "_")
    t.create_tables(spark, name, str(tmp_path / "wh"))
    yield name
    t.drop_tables(spark, name)


def members(*ids):
    return [(i, "f", "l", "g", "free") for i in ids]


def users(spark, *ids):
    return spark.createDataFrame(members(*ids), "user_id int, first_name string, last_name string, gender string, level string")


def test_create_and_drop(spark, database, tmp_path):
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()} == set(star_tables())
    t.append(users(spark, 1), database, "users")
    t.create_tables(spark, database, str(tmp_path / "wh"))  # keeps what is there
    assert t.load(spark, database, "users").count() == 1
    t.drop_tables(spark, database)
    t.drop_tables(spark, database)
    t.create_tables(spark, database, str(tmp_path / "wh"))
    assert t.load(spark, database, "users").count() == 0


def test_append_matches_by_name(spark, database):
    t.append(users(spark, 1).select("level", "gender", "user_id", "last_name", "first_name"), database, "users")
    t.append(users(spark, 2), database, "users")
    assert rows(t.load(spark, database, "users")) == members(1, 2)


def test_text_beyond_declared_length_fails(spark, database):
    long = users(spark, 1).selectExpr("user_id", "repeat('x', 257) first_name", "last_name", "gender", "level")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        t.append(long, database, "users")
    assert t.load(spark, database, "users").count() == 0


def versions(spark, tmp_path):
    return sorted(p.name for p in (tmp_path / "wh/users").iterdir() if p.is_dir())


def test_replace_may_read_the_table(spark, database, tmp_path):
    t.append(users(spark, 1, 2), database, "users")
    before = t.load(spark, database, "users")
    t.replace(before.unionByName(users(spark, 3)), database, "users")
    assert rows(t.load(spark, database, "users")) == members(1, 2, 3)
    assert len(versions(spark, tmp_path)) == 2
    t.append(users(spark, 4), database, "users")
    assert t.load(spark, database, "users").count() == 4
    t.replace(t.load(spark, database, "users"), database, "users")
    assert len(versions(spark, tmp_path)) == 2  # the one before the last is gone
    t.replace(t.load(spark, database, "users"), database, "users", keep_previous=False)
    assert len(versions(spark, tmp_path)) == 1
    assert rows(t.load(spark, database, "users")) == members(1, 2, 3, 4)


@pytest.mark.parametrize("level, message", [("raise_error('stop')", "stop"), ("repeat('x', 257)", "level exceeds 256")])
def test_failed_replace_changes_nothing(spark, database, level, message):
    t.append(users(spark, 1), database, "users")
    broken = t.load(spark, database, "users").selectExpr(
        "user_id", "first_name", "last_name", "gender", f"cast({level} as string) level"
    )
    with pytest.raises(Exception, match=message):
        t.replace(broken, database, "users")
    assert rows(t.load(spark, database, "users")) == members(1)


def test_hidden_columns_and_a_veto_before_the_switch(spark, database, tmp_path):
    t.append(users(spark, 1), database, "users")
    seen = []
    more = users(spark, 2).withColumn("note", F.lit("kept"))
    t.replace(more, database, "users", hidden=["note"], before_switch=lambda f: seen.append(spark.read.parquet(f).first().note))
    assert seen == ["kept"] and rows(t.load(spark, database, "users")) == members(2)

    def veto(folder):
        raise RuntimeError("no")

    old = versions(spark, tmp_path)
    with pytest.raises(RuntimeError):
        t.replace(users(spark, 3), database, "users", before_switch=veto)
    assert rows(t.load(spark, database, "users")) == members(2)
    assert set(versions(spark, tmp_path)) <= set(old)


def test_clear(spark, database):
    t.append(users(spark, 1), database, "users")
    t.clear(spark, database, "users")
    assert t.load(spark, database, "users").count() == 0
    t.append(users(spark, 6), database, "users")
    assert rows(t.load(spark, database, "users")) == members(6)
