"""Checks for the constraints that Parquet tables do not enforce."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.references import joined_counts


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, n_nulls)`` for every column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_nulls")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(*keys, n)`` of keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    keys: Mapping[str, str] | Sequence[str],
    parent_unique: bool = False,
) -> DataFrame:
    """Distinct child keys without a parent; keys with a NULL refer to nothing and pass.

    ``keys`` maps child columns to parent columns, or lists columns of the same name. Both sides are made distinct
    before the join, unless the parent's key is known to be unique.
    """
    pairs = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    wanted = child.select(*pairs).dropna().distinct()
    known = parent.select(*[F.col(p).alias(c) for c, p in pairs.items()])
    return wanted.join(known if parent_unique else known.distinct(), list(pairs), "left_anti")


def completeness(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per dimension: fact rows, fact rows that join, and whether the two are equal; the fact is read once.

    ``dims`` maps a name to ``(dimension, key)``. A NULL key counts as a fact row that does not join.
    """
    return joined_counts(fact, dims).withColumn("complete", F.col("fact_rows") == F.col("joined_rows"))
