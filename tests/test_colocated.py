"""A fact and a dimension divided alike: joins without a shuffle, split keys, later batches."""

import pytest
from pyspark.sql import functions as F

from starloom.sources.colocated import PIECE, Colocated
from tests.conftest import rows


@pytest.fixture
def database(spark, tmp_path):
    name = "co_" + tmp_path.name.replace("-", "_")
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def plays(spark, first, n, hot=7, kind="bigint"):
    """A third of the plays are of one key, some have none, some have no member."""
    key = F.expr(f"CASE WHEN id % 3 = 0 THEN {hot} WHEN id % 10 = 1 THEN NULL ELSE id % 40 END").cast(kind)
    return spark.range(first, first + n).select(F.col("id").alias("songplay_id"), key.alias("user_id"))


def users(spark, level="free"):
    return spark.range(30).select(F.col("id").cast("int").alias("user_id"), F.lit(level).alias("level"), (F.col("id") % 4).alias("kind"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def expected(all_plays, members, how="inner"):
    members = members.withColumn("user_id", F.col("user_id").cast(all_plays.schema["user_id"].dataType))
    return rows(all_plays.join(members, "user_id", how).select("songplay_id", "user_id", "level", "kind"))


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("hot_rows", [50, 1_000_000])
def test_joins_move_no_rows(spark, tmp_path, database, shuffled_joins, kind, hot_rows):
    fact, dim = plays(spark, 0, 600, kind=kind), users(spark)
    store = Colocated(spark, database, "by_user", "user_id", 8, hot_rows)
    store.create(fact, dim, str(tmp_path / "t"))
    columns = ["songplay_id", "user_id", "level", "kind"]
    for how in ("inner", "left"):
        assert rows(store.joined(how).select(*columns)) == expected(fact, dim, how)
        assert "Exchange" not in plan(store.joined(how))
    counted = store.counted(["kind"])
    assert plan(counted).count("Exchange") == 1 and "hashpartitioning(kind" in plan(counted)
    assert sum(r.n for r in counted.collect()) == len(expected(fact, dim))
    held = spark.table(f"{database}.by_user").filter("user_id = '7'").groupBy(PIECE).count().collect()
    assert len(held) == (5 if hot_rows == 50 else 1)
    assert not spark.table(f"{database}.by_user").filter("user_id IS NULL").groupBy(PIECE).count().filter("count > 20").count()


def test_later_batches_and_members(spark, tmp_path, database, shuffled_joins):
    """A key becomes frequent in a later batch, members change, a member arrives late."""
    first, second, third = plays(spark, 0, 90, hot=3), plays(spark, 90, 600, hot=7), plays(spark, 690, 90, hot=35)
    store = Colocated(spark, database, "by_user", "user_id", 4, hot_rows=100)
    store.create(first, users(spark), str(tmp_path / "t"))
    assert not store._pieces()
    store.append(second)
    assert list(store._pieces().values()) == [3]
    store.append(third)
    assert list(store._pieces().values()) == [3]
    every = first.union(second).union(third)
    columns = ["songplay_id", "user_id", "level", "kind"]
    assert rows(store.joined().select(*columns)) == expected(every, users(spark))

    changed = users(spark, "paid").union(spark.sql("SELECT 35, 'free', 3L"))
    before = store.joined()
    store.replace_members(changed)
    assert before.count() == len(expected(every, users(spark)))  # files of the previous version are still there
    assert rows(store.joined().select(*columns)) == expected(every, changed)
    assert "Exchange" not in plan(store.joined())
    assert sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()) == ["by_user", "by_user_members"]


def test_empty_tables_and_keys_in_odd_columns(spark, tmp_path, database, shuffled_joins):
    store = Colocated(spark, database, "by_user", "user_id", 2)
    store.create(plays(spark, 0, 0), users(spark).limit(0), str(tmp_path / "t"))
    assert store.joined().count() == 0 and store.counted(["level"]).count() == 0
    store.append(plays(spark, 0, 60))
    assert store.joined("left").count() == 60 and store.joined().count() == 0
    store.replace_members(users(spark).union(spark.sql("SELECT NULL, 'x', 0L")))
    assert rows(store.joined().select("songplay_id", "user_id", "level", "kind")) == expected(plays(spark, 0, 60), users(spark))


def test_columns_of_both_sides_are_refused(spark, tmp_path, database):
    store = Colocated(spark, database, "by_user", "user_id", 2)
    with pytest.raises(ValueError, match="level"):
        store.create(plays(spark, 0, 9).withColumn("level", F.lit("paid")), users(spark), str(tmp_path / "t"))
