"""Equi-joins that stay even when one key holds a large share of the rows on either side.

The right side is broadcast only where Spark's own size check allows it. Beyond that both sides are shuffled, and the
rows of frequent keys are dealt out in pieces: the pieces of one side meet every piece of the other side, so no pair
is lost and none appears twice. Rows without a full key match nothing and are spread as well.

Which keys are frequent is found before the join is planned, by one scan of the key columns. Only a list of bounded
length comes out of it, and without frequent keys the join is an ordinary one. The list steers how rows travel, never
which rows match; whatever it misses is left to adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # a key with more rows than this is split into pieces of about this size
MAX_HOT_KEYS = 1_000  # length of the list of frequent keys of one side
MAX_PIECES = 10_000
NULL_KEY_PIECES = 4_096
SKETCH_ITEMS = 4_096  # a key with more than about a thousandth of the rows is found for sure
SKETCH_GROUPS = 256  # sketches are merged in this many tasks before the last one
ESTIMATE_UNDER = 4  # how many times a size estimate from compressed files may fall short of the rows in memory


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's size estimate, times ``ESTIMATE_UNDER``, puts ``df`` under ``spark.sql.autoBroadcastJoinThreshold``.

    The estimate of a scan is its compressed file size; the rows in memory of the names of parts came to 24 to 40 times
    more. With the allowance a broadcast stays bounded (about 100 MB at most for such names) however large the input.
    """
    try:
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return 0 <= df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() * ESTIMATE_UNDER <= limit
    except AttributeError:  # no plan access, as over a remote connection: take the way that needs no bound
        return False


def _all_of(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conditions)


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def _n_pieces(rows: int, hot_rows: int) -> int:
    return min(-(-rows // hot_rows), MAX_PIECES)


def hot_lists(df: DataFrame, key_sets: Sequence[Sequence[str]], hot_rows: int = HOT_ROWS) -> list[list[tuple[int, int]]]:
    """For each set of key columns ``(hash of the key, pieces)`` of keys with more than ``hot_rows`` rows.

    One scan of ``df`` with a frequent-items sketch per task and set. No key is shuffled, only sketches of fixed size.
    """
    entries = []
    for i, keys in enumerate(key_sets):
        known = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])
        entries.append(F.struct(F.lit(i).alias("which"), F.when(known, key_hash(keys)).alias("item")))
    hashes = df.select(F.inline(F.array(*entries))).filter("item IS NOT NULL")
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part")
    sketches = hashes.groupBy("which", group).agg(F.expr(f"approx_top_k_accumulate(item, {SKETCH_ITEMS})").alias("sketch"))
    # Merged by a key: without one, empty partitions would contribute sketches that cannot be merged.
    merged = sketches.groupBy("which").agg(F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch"))
    top = merged.select("which", F.expr(f"inline(approx_top_k_estimate(sketch, {MAX_HOT_KEYS}))"))
    found: list[list[tuple[int, int]]] = [[] for _ in key_sets]
    for r in top.filter(F.col("count") > hot_rows).collect():
        found[r["which"]].append((r["item"], _n_pieces(r["count"], hot_rows)))
    return found


def hot_hashes(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> list[tuple[int, int]]:
    """:func:`hot_lists` of one set of key columns."""
    return hot_lists(df, [keys], hot_rows)[0]


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> list[tuple]:
    """``(*key, pieces)`` of the most frequent keys with more than ``hot_rows`` rows, counted exactly."""
    counts = df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    top = counts.filter(F.col("__n") > hot_rows).orderBy(F.desc("__n")).limit(MAX_HOT_KEYS)
    return [(*[r[k] for k in keys], _n_pieces(r["__n"], hot_rows)) for r in top.collect()]


def deal(columns: Sequence[str], pieces: Column | int) -> Column:
    """Piece of a row, from its values and its input partition.

    The partition number spreads exact copies of a row; neither part depends on the order of rows, so a task that
    runs twice deals the same way.
    """
    return F.pmod(key_hash(columns) + F.spark_partition_id(), F.lit(pieces) if isinstance(pieces, int) else pieces)


def copies(pieces: Column) -> Column:
    """One row per piece; one row for keys that are not split."""
    zero = F.lit(0).cast("bigint")
    return F.explode(F.when(pieces.isNull(), F.array(zero)).otherwise(F.sequence(zero, pieces - 1)))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    right_unique: bool = False,
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    left_hot: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """Join on pairs of column names; the result has all left columns and the right columns that are not keys.

    ``how`` is ``inner``, ``left`` or ``left_anti``. With ``right_unique`` no key of the right side is split.
    ``hot_from`` has the left key columns too and is scanned for frequent keys instead of ``left``, where ``left`` is
    costly to compute; ``left_hot`` is what :func:`hot_hashes` found already.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    left_keys = [l for l, _ in on]
    names = {r: f"__key{i}" for i, (_, r) in enumerate(on)}
    keys = list(names.values())
    if how == "left_anti":
        right, right_unique = right.select(*names), True
    right = right.withColumnsRenamed(names)
    matches = [F.col(f"`{l}`") == F.col(k) for l, k in zip(left_keys, keys)]

    if fits_broadcast(right):
        joined = left.join(right, _all_of(matches), how)
        return joined if how == "left_anti" else joined.drop(*keys)

    spark = left.sparkSession
    right = right.dropna(subset=keys)
    left_columns, right_columns = left.columns, right.columns
    if left_hot is None:
        left_hot = hot_hashes(left if hot_from is None else hot_from, left_keys, hot_rows)
    right_hot = [] if right_unique else hot_keys(right, keys, hot_rows)

    # Pieces of the left side: column __l, and every right row once per piece of its key.
    no_key = reduce(Column.__or__, [F.col(f"`{l}`").isNull() for l in left_keys])
    spread = F.when(no_key, deal(left_columns, NULL_KEY_PIECES))
    if left_hot:
        hot = F.broadcast(spark.createDataFrame(left_hot, "__hash bigint, __pieces bigint"))
        left = left.join(hot, key_hash(left_keys) == F.col("__hash"), "left")
        spread = spread.when(F.col("__pieces").isNotNull(), deal(left_columns, F.col("__pieces")))
        right = right.join(hot, key_hash(keys) == F.col("__hash"), "left").withColumn("__rl", copies(F.col("__pieces")))
        right = right.drop("__hash", "__pieces")
    else:
        right = right.withColumn("__rl", F.pmod(key_hash(keys), F.lit(1)))
    left = left.withColumn("__l", spread.otherwise(F.lit(0))).drop("__hash", "__pieces")
    matches.append(F.col("__l") == F.col("__rl"))

    # Pieces of the right side: column __rr, and every left row once per piece of its key.
    if right_hot:
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in right.select(*keys).schema.fields)
        hot = F.broadcast(spark.createDataFrame(right_hot, f"{kinds}, __pieces bigint"))
        left = left.join(hot, _all_of(matches[:-1]), "left").drop(*keys).withColumn("__r", copies(F.col("__pieces")))
        left = left.withColumnRenamed("__pieces", "__split")
        right = right.join(hot, keys, "left").withColumn(
            "__rr", F.when(F.col("__pieces").isNotNull(), deal(right_columns, F.col("__pieces"))).otherwise(F.lit(0))
        )
        right = right.drop("__pieces").withColumn("__matched", F.lit(True))
        matches.append(F.col("__r") == F.col("__rr"))

    joined = left.join(right.hint("merge"), _all_of(matches), how)  # too large for a broadcast, whatever its estimate
    if right_hot and how == "left":
        # A key split on the right has right rows for sure; a piece without any is not a missing match.
        joined = joined.filter(F.col("__split").isNull() | F.col("__matched").isNotNull())
    return joined.drop("__l", "__r", "__rl", "__rr", "__split", "__matched", *keys)
