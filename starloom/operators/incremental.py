"""Insert-if-absent: what a load may add to a table that already holds rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.bitmap import key_bitmap, maybe_in
from starloom.operators.skew import HOT_ROWS, fits_broadcast, skew_join


def reject_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(keys))


def null_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``n_rejected``: rows :func:`reject_null_keys` would drop."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.agg(F.count_if(missing).alias("n_rejected"))


def within_range_of(target: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """Target rows whose ``column`` lies between the source's least and greatest value.

    No other target row can have a key of the source, so the rest of the target is dropped before it is shuffled.
    """
    low = source.agg(F.min(column)).scalar()
    high = source.agg(F.max(column)).scalar()
    return target.filter((F.col(column) >= low) & (F.col(column) <= high))


def new_keys_only(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    source_unique: bool = False,
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    prune_target: bool = False,
) -> DataFrame:
    """Source rows whose key is not in the target; rows with a NULL in the key are rejected.

    Duplicates inside the source stay. With non-NULL keys this equals ``NOT IN``, but it runs as an anti join on
    shuffled keys. A source with one row per key needs no care for frequent keys. ``prune_target`` is for a small batch
    against a large table: the source's keys are read once more for a bitmap of fixed size, and target rows that it rules
    out are neither made distinct nor shuffled.
    """
    source = reject_null_keys(source, keys)
    seen = reject_null_keys(target.select(*keys), keys)
    if prune_target and not fits_broadcast(seen):
        kinds = {f.name: f.dataType for f in source.select(*keys).schema.fields}
        seen = seen.select(*[F.col(k).cast(kinds[k]).alias(k) for k in keys])
        wanted = source.select(*keys) if hot_from is None else reject_null_keys(hot_from.select(*keys), keys)
        seen = maybe_in(seen, keys, key_bitmap(wanted, keys))
    if source_unique:
        return source.join(seen, list(keys), "left_anti")
    return skew_join(source, seen.distinct(), [(k, k) for k in keys], "left_anti", hot_from=hot_from, hot_rows=hot_rows)


def first_version(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """One row per key with the least value of each column on its own; ``columns`` maps output names to inputs.

    A least text has no buffer of fixed width, so taking it needs sorted rows. Equal rows are therefore counted by hash
    first, and only one row per version of a member is sorted. The filter on the count keeps that step in the plan: a
    mere distinct below MIN would be dropped by the optimizer.
    """
    versions = df.groupBy(key, *dict.fromkeys(columns.values())).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 0")
    return versions.groupBy(key).agg(*[F.min(source).alias(name) for name, source in columns.items()])


def absent_members(dim: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of a one-row-per-key source that the dimension does not have yet."""
    return new_keys_only(source, dim, [key], source_unique=True).select(*dim.columns)


def _literals(like: DataFrame, values: Mapping[str, object]) -> list[Column]:
    """The given values in the columns of ``like``, typed NULLs elsewhere."""
    return [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in like.schema.fields]


def missing_member(dim: DataFrame, values: Mapping[str, object], key: str) -> DataFrame:
    """The constant row if the dimension lacks its key, otherwise no row."""
    present = dim.filter(F.col(key) == values[key]).agg(F.count(F.lit(1)).alias("__n"))
    return present.filter(F.col("__n") == 0).select(*_literals(dim, values))


def ensure_member(dim: DataFrame, values: Mapping[str, object], key: str) -> DataFrame:
    """The dimension with exactly one such member, however often it is applied."""
    return dim.unionByName(missing_member(dim, values, key))
