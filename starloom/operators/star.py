"""Star joins and the reports on them.

Counts are taken before rows are shuffled for a join: a fact key that holds most rows arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.labels import song_category
from starloom.operators.skew import skew_join


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_tables(tables: Mapping[str, DataFrame], tag: str | None = None) -> DataFrame:
    """``(table_name, n)`` of all tables in one job, with the tag in front if there is one."""
    label = [F.lit(tag).alias("tag")] if tag is not None else []
    parts = [
        count_rows(df).select(*label, F.lit(name).alias("table_name"), "n") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def referential_count(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows of the inner join of fact and dimension, from one count per key instead of the joined rows."""
    joined = rows_per_key(fact, [key]).join(dim.select(key), key)
    return joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def plays_by(
    fact: DataFrame, dims: Mapping[str, DataFrame], by: Sequence[str], hot_from: DataFrame | None = None
) -> DataFrame:
    """Plays per combination of dimension attributes, in their order.

    The dimensions are joined one after the other, and plays are counted again after each: what reaches the second
    join is one row per remaining key and attribute, not one per play. ``hot_from`` has the key columns too and is
    scanned for frequent keys instead of a fact that is costly to compute.
    """
    waiting = list(dims)
    counts = rows_per_key(fact, waiting) if len(waiting) == 1 else fact.select(*waiting)
    found: list[str] = []
    for key, dim in dims.items():
        waiting.remove(key)
        wanted = [c for c in by if c in dim.columns and c not in found]
        attributes = dim.select(key, *wanted)
        if "n" in counts.columns:
            counts = counts.join(attributes, key)
            total = F.sum("n")
        else:
            counts = skew_join(counts, attributes, [(key, key)], "inner", right_unique=True, hot_from=hot_from)
            total = F.count(F.lit(1))
        found += wanted
        counts = counts.groupBy(*waiting, *found).agg(total.alias("n"))
    return counts.orderBy(*by)


def match_rate(fact: DataFrame) -> DataFrame:
    """Plays with a known and with the unknown song."""
    return fact.groupBy(song_category(F.col("song_id")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


def songs_with_artists(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Songs joined to their artists."""
    names = artists.select("artist_id", "name")
    joined = skew_join(songs, names, [("artist_id", "artist_id")], "inner", right_unique=True)
    return joined.select("song_id", "title", "year", "artist_id", "name")


def top_k(df: DataFrame, order_by: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(*order_by).limit(k)
