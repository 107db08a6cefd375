"""Dense surrogate keys without a global sort, and without a copy of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_ROWS = 1 << 20  # rows of a range, about
MOST_RANGES = 1 << 14
CUTS_PER_RANGE = 8  # keys drawn for each range


def _cuts(keys: DataFrame, columns: Sequence[str], n_rows: int, n_ranges: int) -> DataFrame:
    """About ``n_ranges - 1`` different keys that divide all keys evenly.

    Keys are drawn by their hash, so the same rows always give the same cuts and copies of a key count once.
    """
    every = max(1, n_rows // (n_ranges * CUTS_PER_RANGE))
    drawn = keys.select(*columns).filter(F.pmod(F.xxhash64(*columns), F.lit(every)) == 0).distinct()
    # At most about MOST_RANGES * CUTS_PER_RANGE keys meet in this one row.
    return drawn.agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("drawn")).select(
        F.explode(F.filter("drawn", lambda _, i: i % CUTS_PER_RANGE == CUTS_PER_RANGE - 1)).alias("cut")
    )


def _with_range(df: DataFrame, columns: Sequence[str], cuts: DataFrame, n_cuts: int) -> DataFrame:
    """``df`` with ``__range``: the number of cuts not above the row's key, by binary search in the sorted cuts."""
    if not n_cuts:
        return df.withColumn("__range", F.pmod(F.xxhash64(*columns), F.lit(1)).cast("int"))
    ordered = cuts.agg(F.array_sort(F.collect_list("cut")).alias("cuts")).scalar()
    key = F.struct(*columns)
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n_cuts.bit_length()))])

    def narrowed(low: Column, step: Column) -> Column:
        return F.when((low + step <= n_cuts) & (F.get("__cuts", low + step - 1) <= key), low + step).otherwise(low)

    return df.withColumn("__cuts", ordered).withColumn("__range", F.aggregate(steps, F.lit(0), narrowed)).drop("__cuts")


def assign_ids(
    df: DataFrame,
    order_by: Sequence[str],
    id_column: str = "songplay_id",
    start: int | Callable[[int], int] = 0,
    n_partitions: int | None = None,
    cuts_from: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ids ``start``, ``start + 1``, … in the order of ``order_by``, which should be unique.

    Keys drawn by hash cut the order into ranges. The cuts are fixed values; one aggregate counts the rows of each range,
    which says where the ids of a range begin, and each range ranks its own rows. Nothing is written in between, and only
    the cuts and one number per range pass through the driver. ``df`` is read twice and must give the same rows both
    times. ``cuts_from`` has the first columns of ``order_by`` and is drawn from instead, if ``df`` is costly to compute.
    ``start`` may be a function that takes the number of rows and returns the first id.
    """
    spark = df.sparkSession
    keys = df if cuts_from is None else cuts_from
    columns = [c for c in order_by if c in keys.columns]
    if columns != list(order_by)[: len(columns)] or not columns:
        raise ValueError(f"cuts_from needs the first columns of {list(order_by)}")
    n_rows = keys.count()
    n_ranges = min(n_partitions or -(-n_rows // RANGE_ROWS), MOST_RANGES)
    fixed = [r.cut for r in _cuts(keys, columns, n_rows, n_ranges).collect()] if n_ranges > 1 else []
    kinds = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in keys.select(*columns).schema.fields)
    cuts = spark.createDataFrame([(c,) for c in fixed], f"cut struct<{kinds}>")
    ranged = _with_range(df, columns, cuts, len(fixed))

    first = start
    offsets = []
    if fixed or callable(start):
        sizes = {r["__range"]: r["n"] for r in ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect()}
        first = start(sum(sizes.values())) if callable(start) else start
        total = first
        for part in sorted(sizes):
            offsets.append((part, total))
            total += sizes[part]
    rank = F.row_number().over(Window.partitionBy("__range").orderBy(*order_by)).cast("bigint") - 1
    others = [c for c in df.columns if c != id_column]
    if not fixed:
        return ranged.select((F.lit(first).cast("bigint") + rank).alias(id_column), *others)
    begins = spark.createDataFrame(offsets, "__range int, __offset bigint")  # at most MOST_RANGES rows
    placed = ranged.withColumn("__rank", rank).join(F.broadcast(begins), "__range")
    return placed.select((F.col("__offset") + F.col("__rank")).alias(id_column), *others)
