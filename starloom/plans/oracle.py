"""The registered queries once more, as plain SQL over the driver tables, to check the DataFrame versions against."""

from __future__ import annotations

from starloom.plans.analogs import (
    BROKEN_PAGE,
    BROKEN_SIZE,
    CATALOGUED_SIZE,
    LOADED_PLAYS_BEFORE,
    LOADED_SONGS_UNTIL,
    LOADED_USERS_BEFORE,
    TITLE_BLOCK,
)
from starloom.schemas import star_tables

_TITLE = f"p_name || ' ' || CAST(p_partkey // {TITLE_BLOCK} AS VARCHAR)"


def _start_time(ms: str) -> str:
    return f"TIMESTAMP '1970-01-01 00:00:00' + CAST({ms} // 1000 AS BIGINT) * INTERVAL 1 SECOND"


# name -> (names of the views it needs, SQL)
_VIEWS: dict[str, tuple[list[str], str]] = {
    "stg_events": (
        [],
        f"""
        SELECT p.p_type AS artist, {_TITLE} || CASE WHEN p_size > {CATALOGUED_SIZE} THEN ' (live)' ELSE '' END AS song, c.c_name AS firstname,
               'N' || CAST(c.c_nationkey AS VARCHAR) AS lastname, c.c_mktsegment AS gender,
               CASE WHEN e.value >= 50 THEN 'paid' ELSE 'free' END AS level,
               CAST(CAST(e.value AS DECIMAL(18,2)) AS DECIMAL(18,0)) AS length,
               'L' || json_extract_string(e.props, '$.k') AS location, e.event_type AS page,
               CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS sessionid,
               epoch_us(e.ts) // 1000 AS ts, e.props AS useragent, e.user_id AS userid, e.event_id
          FROM events e
          LEFT JOIN part p ON p.p_partkey = e.event_id
          LEFT JOIN customer c ON c.c_custkey = e.user_id
        """,
    ),
    "stg_songs": (
        [],
        f"""
        SELECT CAST(1 AS INTEGER) AS num_songs, 'AR' || CAST(p_partkey % 50 AS VARCHAR) AS artist_id,
               CAST(p_retailprice AS DECIMAL(20,6)) AS artist_latitude,
               CAST(p_size AS DECIMAL(20,6)) AS artist_longitude, p_brand AS artist_location,
               p_type AS artist_name, 'SO' || CAST(p_partkey AS VARCHAR) AS song_id, {_TITLE} AS title,
               CAST(p_retailprice AS DECIMAL(12,4)) AS duration, p_size AS year
          FROM part
        """,
    ),
    "plays": (
        ["stg_events"],
        f"SELECT *, {_start_time('ts')} AS start_time FROM stg_events WHERE page = 'view'",
    ),
    "fact": (
        ["plays", "stg_songs"],
        """
        SELECT p.start_time, p.userid AS user_id, p.level, COALESCE(s.song_id, '***UNKNOWN_SONG***') AS song_id,
               COALESCE(s.artist_id, '***UNKNOWN_ARTIST***') AS artist_id, p.sessionid AS session_id, p.location,
               p.useragent AS user_agent, p.event_id
          FROM plays p LEFT JOIN stg_songs s ON s.artist_name = p.artist AND s.title = p.song
        """,
    ),
    "users": (
        ["plays"],
        """
        SELECT userid AS user_id, min(firstname) AS first_name, min(lastname) AS last_name, min(gender) AS gender,
               min(level) AS level
          FROM plays GROUP BY userid
        """,
    ),
    "current_users": (
        ["users", "stg_events"],
        """
        SELECT u.user_id, COALESCE(l.firstname, u.first_name) AS first_name,
               COALESCE(l.lastname, u.last_name) AS last_name, COALESCE(l.gender, u.gender) AS gender,
               COALESCE(l.level, u.level) AS level
          FROM users u
          LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY userid ORDER BY ts DESC, event_id DESC) AS nth
                       FROM stg_events) l
            ON l.userid = u.user_id AND l.nth = 1
        """,
    ),
    "catalogue_songs": (
        ["stg_songs"],
        """
        SELECT song_id, min(title) AS title, min(artist_id) AS artist_id, min(year) AS year, min(duration) AS duration
          FROM stg_songs GROUP BY song_id
        """,
    ),
    "songs": (
        ["catalogue_songs"],
        """
        SELECT * FROM catalogue_songs
        UNION ALL SELECT '***UNKNOWN_SONG***', '***Unknown Song***', '***UNKNOWN_ARTIST***', NULL, NULL
        """,
    ),
    "catalogue_artists": (
        ["stg_songs"],
        """
        SELECT artist_id, min(artist_name) AS name, min(artist_location) AS location,
               min(artist_latitude) AS latitude, min(artist_longitude) AS longitude
          FROM stg_songs GROUP BY artist_id
        """,
    ),
    "artists": (
        ["catalogue_artists"],
        """
        SELECT * FROM catalogue_artists
        UNION ALL SELECT '***UNKNOWN_ARTIST***', '*** Unknown Artist ***', NULL, NULL, NULL
        """,
    ),
    "keyed": (
        ["fact"],
        "SELECT row_number() OVER (ORDER BY event_id, song_id) - 1 AS songplay_id, * FROM fact",
    ),
    "time_rows": (
        ["plays"],
        """
        SELECT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
               CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
               CAST(year(start_time) AS INTEGER) AS year, CAST(dayofweek(start_time) AS INTEGER) AS weekday
          FROM (SELECT DISTINCT start_time FROM plays)
        """,
    ),
}


def _with(sql: str, *views: str) -> str:
    """The query behind a WITH clause of the named views and of whatever those need."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order:
            return
        for other in _VIEWS[name][0]:
            need(other)
        order.append(name)

    for view in views:
        need(view)
    return "WITH " + ", ".join(f"{v} AS ({_VIEWS[v][1].strip()})" for v in order) + " " + sql.strip()


def _count_join(left: str, dim: str, key: str) -> str:
    return _with(f"SELECT count(*) AS n FROM {left} x JOIN {dim} d ON d.{key} = x.{key}", left, dim)


def _plays_by(*columns: str) -> str:
    listed = ", ".join(columns)
    users = "JOIN current_users u ON u.user_id = x.user_id" if len(columns) > 3 else ""
    return _with(
        f"""SELECT {listed}, count(*) AS n
              FROM (SELECT start_time, user_id FROM fact) x JOIN time_rows t ON t.start_time = x.start_time {users}
             GROUP BY {listed}""",
        "fact",
        "time_rows",
        "current_users",
    )


def _loose() -> str:
    return _with(
        """SELECT CAST(9999 AS INTEGER) AS dummy, p.start_time, p.userid AS user_id, p.level,
                  COALESCE(s.song_id, p.song) AS song_id, COALESCE(a.artist_id, p.artist) AS artist_id,
                  p.sessionid AS session_id, p.location, p.useragent AS user_agent, p.event_id
             FROM plays p LEFT JOIN artists a ON a.name = p.artist LEFT JOIN songs s ON s.title = p.song""",
        "plays",
        "artists",
        "songs",
    )


_DIM_VIEWS = {
    "time": ("time_rows", "start_time"),
    "users": ("users", "user_id"),
    "songs": ("songs", "song_id"),
    "artists": ("artists", "artist_id"),
}


def _completeness() -> str:
    dims = _DIM_VIEWS
    parts = [
        f"""SELECT '{name}' AS dimension, (SELECT count(*) FROM fact) AS fact_rows,
                   (SELECT count(*) FROM fact x JOIN {view} d ON d.{key} = x.{key}) AS joined_rows"""
        for name, (view, key) in dims.items()
    ]
    report = " UNION ALL ".join(parts)
    return _with(
        f"SELECT *, fact_rows = joined_rows AS complete FROM ({report})", "fact", *[v for v, _ in dims.values()]
    )


def _count_joins() -> str:
    parts = [
        f"SELECT '{name}' AS dimension, (SELECT count(*) FROM fact x JOIN {view} d ON d.{key} = x.{key}) AS n"
        for name, (view, key) in _DIM_VIEWS.items()
    ]
    return _with(" UNION ALL ".join(parts), "fact", *[v for v, _ in _DIM_VIEWS.values()])


def _references() -> list[tuple[str, str, str, str]]:
    """Referring table, its view, column and referenced table of every declared reference."""
    return [
        (t.name, {"songplays": "fact"}.get(t.name, t.name), column, parent)
        for t in star_tables().values()
        for column, parent in t.references.items()
    ]


def _foreign_keys() -> str:
    parts = []
    for table, view, column, parent in _references():
        dim, key = _DIM_VIEWS[parent]
        orphan = f"x.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = x.{column})"
        parts.append(
            f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{parent}' AS parent_name,
                       count({column}) AS n_rows, count(DISTINCT {column}) AS n_keys, count(*) - count({column}) AS n_nulls,
                       (SELECT count(*) FROM {view} x WHERE {orphan}) AS orphan_rows,
                       (SELECT count(DISTINCT {column}) FROM {view} x WHERE {orphan}) AS orphan_keys
                  FROM {view}"""
        )
    return _with(" UNION ALL ".join(parts), "fact", *[v for v, _ in _DIM_VIEWS.values()])


def _orphan_keys() -> str:
    known = {
        "time": f"SELECT start_time AS k FROM plays WHERE start_time < TIMESTAMP '{LOADED_PLAYS_BEFORE}'",
        "users": f"SELECT userid AS k FROM plays WHERE start_time < TIMESTAMP '{LOADED_USERS_BEFORE}'",
        "songs": f"SELECT song_id AS k FROM stg_songs WHERE year <= {LOADED_SONGS_UNTIL} UNION ALL SELECT '***UNKNOWN_SONG***'",
        "artists": f"SELECT artist_id AS k FROM stg_songs WHERE year <= {LOADED_SONGS_UNTIL} UNION ALL SELECT '***UNKNOWN_ARTIST***'",
    }
    parts = [
        f"""SELECT '{table}' AS table_name, '{column}' AS column_name, CAST({column} AS VARCHAR) AS key, count(*) AS n
              FROM {view} x WHERE NOT EXISTS (SELECT 1 FROM ({known[parent]}) o WHERE o.k = x.{column}) GROUP BY {column}"""
        for table, view, column, parent in _references()
    ]
    return _with(" UNION ALL ".join(parts), "fact", "songs", "stg_songs", "plays")


def _primary_keys() -> str:
    parts = [
        f"""SELECT '{name}' AS table_name, '{key}' AS column_name, count(*) AS n_rows, count(*) - count({key}) AS n_nulls,
                   count(DISTINCT {key}) AS n_keys,
                   (SELECT count(*) FROM (SELECT {key} FROM {view} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)) AS n_duplicated
              FROM {view}"""
        for name, (view, key) in {**_DIM_VIEWS, "songplays": ("keyed", "songplay_id")}.items()
    ]
    return _with(" UNION ALL ".join(parts), "keyed", *[v for v, _ in _DIM_VIEWS.values()])


def _event_documents() -> str:
    columns = ["level", "length", "location", "page", "sessionid", "ts", "useragent", "userid"]
    listed = ", ".join(f"CASE WHEN page <> '{BROKEN_PAGE}' THEN {c} END AS {c}" for c in columns)
    return _with(f"SELECT event_id, {listed}, page = '{BROKEN_PAGE}' AS broken FROM stg_events", "stg_events")


def _song_documents() -> str:
    columns = star_tables()["staging_songs"].schema.names
    listed = ", ".join(f"CASE WHEN year <> {BROKEN_SIZE} THEN {c} END AS {c}" for c in columns)
    return _with(f"SELECT CAST(substr(song_id, 3) AS BIGINT) AS p_partkey, {listed}, year = {BROKEN_SIZE} AS broken FROM stg_songs", "stg_songs")


_ACCEPTED = """
    SELECT event_id, level, CASE WHEN page <> 'click' THEN length END AS length, page,
           CASE WHEN page <> 'signup' THEN sessionid END AS sessionid, CASE WHEN page <> 'purchase' THEN userid END AS userid,
           CASE WHEN page <> 'error' THEN useragent END AS useragent,
           CAST(CASE WHEN page IN ('click', 'purchase', 'error') THEN 1 ELSE 0 END AS INTEGER) AS n_rejected
      FROM stg_events
"""
_REJECTS = """
    SELECT event_id, 'length' AS column_name, CAST(length AS VARCHAR) || ' s' AS raw_value, 'not a decimal(18,0)' AS reason
      FROM stg_events WHERE page = 'click'
    UNION ALL SELECT event_id, 'userid', 'u' || CAST(userid AS VARCHAR), 'not a int' FROM stg_events WHERE page = 'purchase'
    UNION ALL SELECT event_id, 'useragent', repeat(useragent, 200), 'too long' FROM stg_events WHERE page = 'error'
"""


def _count_tables() -> str:
    tables = {
        "staging_events": "stg_events",
        "staging_songs": "stg_songs",
        "songplays": "fact",
        "time": "time_rows",
        "users": "users",
        "songs": "songs",
        "artists": "artists",
    }
    parts = [f"SELECT '{name}' AS table_name, count(*) AS n FROM {view}" for name, view in tables.items()]
    return _with(" UNION ALL ".join(parts), *tables.values())


def _null_counts() -> str:
    columns = ["artist", "song", "firstname", "lastname", "gender", "level", "length", "location", "page"]
    columns += ["sessionid", "ts", "useragent", "userid", "event_id"]
    parts = [f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_nulls FROM stg_events" for c in columns]
    return _with(" UNION ALL ".join(parts), "stg_events")


def _required() -> str:
    views = {"songplays": "fact", "time": "time_rows", "users": "users", "songs": "songs", "artists": "artists"}
    present = {"songplays": {"songplay_id"}}  # the fact view has no ids
    parts = []
    for name, view in views.items():
        for c in star_tables()[name].required:
            if c not in present.get(name, set()):
                parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS n_nulls FROM {view}")
    return _with(" UNION ALL ".join(parts), *views.values())


ORACLE: dict[str, str] = {
    "stage_events": _with("SELECT * FROM stg_events", "stg_events"),
    "stage_songs": _with("SELECT * FROM stg_songs", "stg_songs"),
    "plays_only": _with("SELECT * FROM stg_events WHERE page = 'view'", "stg_events"),
    "in_list": _with("SELECT * FROM stg_events WHERE page IN ('view', 'click')", "stg_events"),
    "case_decode": _with(
        """SELECT page, CASE page WHEN 'view' THEN 'V' WHEN 'click' THEN 'C' WHEN 'purchase' THEN 'P'
                                  WHEN 'signup' THEN 'S' ELSE '????' END AS code, count(*) AS n
             FROM stg_events GROUP BY page""",
        "stg_events",
    ),
    "epoch_to_timestamp": _with(
        f"SELECT DISTINCT {_start_time('ts')} AS start_time FROM stg_events", "stg_events"
    ),
    "users_dim": _with("SELECT * FROM users", "users"),
    "songs_dim": _with("SELECT * FROM songs", "songs"),
    "artists_dim": _with("SELECT * FROM artists", "artists"),
    "time_dim": _with("SELECT * FROM time_rows", "time_rows"),
    "ensure_member_idempotent": _with("SELECT * FROM songs", "songs"),
    "users_incremental": _with(
        f"""SELECT * FROM users WHERE user_id NOT IN
            (SELECT userid FROM plays WHERE start_time < TIMESTAMP '{LOADED_USERS_BEFORE}')""",
        "users",
        "plays",
    ),
    "songs_incremental": _with(
        f"""SELECT * FROM catalogue_songs WHERE song_id NOT IN
            (SELECT song_id FROM stg_songs WHERE year <= {LOADED_SONGS_UNTIL})""",
        "catalogue_songs",
        "stg_songs",
    ),
    "artists_incremental": _with(
        f"""SELECT * FROM catalogue_artists WHERE artist_id NOT IN
            (SELECT artist_id FROM stg_songs WHERE year <= {LOADED_SONGS_UNTIL})""",
        "catalogue_artists",
        "stg_songs",
    ),
    "time_incremental": _with(
        f"""SELECT * FROM time_rows WHERE start_time NOT IN
            (SELECT start_time FROM plays WHERE start_time < TIMESTAMP '{LOADED_PLAYS_BEFORE}')""",
        "time_rows",
        "plays",
    ),
    "users_upsert": _with("SELECT * FROM current_users", "current_users"),
    "users_changed": _with(
        """SELECT n.* FROM current_users n JOIN users o ON o.user_id = n.user_id
            WHERE n.first_name IS DISTINCT FROM o.first_name OR n.last_name IS DISTINCT FROM o.last_name
               OR n.gender IS DISTINCT FROM o.gender OR n.level IS DISTINCT FROM o.level""",
        "current_users",
        "users",
    ),
    "songplays_full": _with("SELECT * FROM fact", "fact"),
    "songplays_incremental": _with(
        f"""SELECT * FROM fact x WHERE NOT EXISTS
            (SELECT 1 FROM plays o WHERE o.start_time < TIMESTAMP '{LOADED_PLAYS_BEFORE}'
                AND o.start_time = x.start_time AND o.userid = x.user_id AND o.sessionid = x.session_id)""",
        "fact",
        "plays",
    ),
    "songplays_fallback": _with(
        """SELECT p.start_time, p.userid AS user_id, p.level, COALESCE(s.song_id, p.song) AS song_id,
                  COALESCE(s.artist_id, p.artist) AS artist_id, p.sessionid AS session_id, p.location,
                  p.useragent AS user_agent, p.event_id
             FROM plays p LEFT JOIN stg_songs s ON s.artist_name = p.artist AND s.title = p.song""",
        "plays",
        "stg_songs",
    ),
    "songplays_keyed": _with("SELECT * FROM keyed", "keyed"),
    "loose_preview": _loose(),
    "like_song": _with("SELECT * FROM fact WHERE song_id LIKE 'SO%'", "fact"),
    "like_artist": _with("SELECT * FROM fact WHERE artist_id LIKE 'AR%'", "fact"),
    "not_like_song": _with("SELECT * FROM fact WHERE song_id NOT LIKE 'SO%'", "fact"),
    "preview_songplays": _with("SELECT * FROM fact ORDER BY event_id, song_id LIMIT 10", "fact"),
    "count_tables": _count_tables(),
    "count_fact_time": _count_join("fact", "time_rows", "start_time"),
    "count_fact_users": _count_join("fact", "users", "user_id"),
    "count_fact_songs": _count_join("fact", "songs", "song_id"),
    "count_fact_artists": _count_join("fact", "artists", "artist_id"),
    "plays_by_week": _plays_by("year", "month", "week"),
    "plays_by_week_level": _plays_by("year", "month", "week", "level"),
    "plays_by_week_gender": _plays_by("year", "month", "week", "gender"),
    "known_unknown": _with(
        """SELECT CASE WHEN song_id = '***UNKNOWN_SONG***' THEN 'Unknown' ELSE 'Known' END AS category,
                  count(*) AS n FROM fact GROUP BY 1""",
        "fact",
    ),
    "songs_artists": _with(
        """SELECT s.song_id, s.title, s.year, a.artist_id, a.name
             FROM songs s JOIN artists a ON a.artist_id = s.artist_id""",
        "songs",
        "artists",
    ),
    "songs_artists_count": _count_join("songs", "artists", "artist_id"),
    "topk_songs": _with("SELECT * FROM songs ORDER BY song_id LIMIT 5", "songs"),
    "dq_nulls": _null_counts(),
    "dq_required": _required(),
    "dq_duplicates": _with(
        "SELECT artist_name, title, count(*) AS n FROM stg_songs GROUP BY ALL HAVING count(*) > 1", "stg_songs"
    ),
    "dq_orphans": _with(
        """SELECT DISTINCT artist, song FROM plays p
            WHERE artist IS NOT NULL AND song IS NOT NULL AND NOT EXISTS
                  (SELECT 1 FROM stg_songs s WHERE s.artist_name = p.artist AND s.title = p.song)""",
        "plays",
        "stg_songs",
    ),
    "completeness": _completeness(),
    "count_joins": _count_joins(),
    "dq_foreign_keys": _foreign_keys(),
    "dq_orphan_keys": _orphan_keys(),
    "dq_primary_keys": _primary_keys(),
    "stage_events_json": _event_documents(),
    "stage_songs_json": _song_documents(),
    "load_accepted": _with(_ACCEPTED, "stg_events"),
    "load_rejects": _with(_REJECTS, "stg_events"),
    "stored_users": _with("SELECT CAST(user_id AS INTEGER) AS user_id, first_name, last_name, gender, level FROM current_users", "current_users"),
    "stored_time": _with("SELECT * FROM time_rows", "time_rows"),
    "colocated_users": _with(
        "SELECT u.level, u.gender, count(*) AS n FROM fact f JOIN current_users u ON u.user_id = f.user_id GROUP BY ALL", "fact", "current_users"
    ),
    "colocated_songs": _with("SELECT f.event_id, s.song_id, s.title, s.year FROM fact f JOIN songs s ON s.song_id = f.song_id", "fact", "songs"),
}
