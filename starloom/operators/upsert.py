"""Latest-wins overwrite of existing members (type 1)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.dimensions import USER_COLUMNS
from starloom.schemas import PLAY_PAGE


_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}
_MOST_DIGITS, _LEAST_DIGITS = 38, 15


def packed_order(df: DataFrame, columns: Sequence[str]) -> Column | None:
    """One decimal that sorts rows as ``columns`` do, NULL first; None if they are not whole numbers or too many.

    A maximum of it has a buffer of fixed width, which one of a struct has not. The first column gets the digits that the
    others leave; its values beyond them (for a bigint and two ints, beyond 4e17) count as equal.
    """
    kinds = dict(df.select(*columns).dtypes)
    if not all(kinds[c] in _BITS for c in columns):
        return None
    digits = [len(str((1 << _BITS[kinds[c]]) + 1)) for c in columns]
    digits[0] = min(digits[0], _MOST_DIGITS - sum(digits[1:]))
    if digits[0] < min(_LEAST_DIGITS, len(str((1 << _BITS[kinds[columns[0]]]) + 1))):
        return None
    packed = None
    for c, n in zip(columns, digits):
        half = min(1 << (_BITS[kinds[c]] - 1), 4 * 10 ** (n - 1))
        value = F.greatest(F.least(F.col(c).cast("decimal(38,0)"), F.lit(Decimal(half))), F.lit(Decimal(-half)))
        placed = F.when(F.col(c).isNull(), F.lit(Decimal(0))).otherwise(value + F.lit(Decimal(half + 1)))
        packed = placed if packed is None else packed * F.lit(Decimal(10**n)) + placed
    return packed.cast(f"decimal({_MOST_DIGITS},0)")


def _versions(source: DataFrame, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[str], *more: Column) -> DataFrame:
    """One row per key and version of its attributes, with the greatest order as ``__order``: hashed, not sorted."""
    order = packed_order(source, order_by)
    order = F.struct(*order_by) if order is None else order
    return source.groupBy(*dict.fromkeys([*keys, *columns])).agg(F.max(order).alias("__order"), *more)


def latest_version(
    source: DataFrame, source_key: str, key: str, columns: Mapping[str, str], order_by: Sequence[str]
) -> DataFrame:
    """Per key the values of the row that is last by ``order_by``; a full tie goes to the greatest values."""
    versions = _versions(source.filter(F.col(source_key).isNotNull()), [source_key], list(columns.values()), order_by)
    ranked = F.struct("__order", *[F.col(s).alias(f"__{n}") for n, s in columns.items()])
    last = versions.groupBy(F.col(source_key).alias(key)).agg(F.max(ranked).alias("__last"))
    return last.select(key, *[F.col(f"__last.__{n}").alias(n) for n in columns])


def upsert_latest(
    dim: DataFrame,
    source: DataFrame,
    source_key: str,
    key: str,
    columns: Mapping[str, str],
    order_by: Sequence[str],
) -> DataFrame:
    """The dimension with each listed attribute taken from the key's latest source row.

    Members without a source row and attributes whose latest value is NULL keep what they have; no member is added.
    The source collapses to one row per key before it is shuffled, so a busy key costs nothing extra.
    """
    latest = latest_version(source, source_key, key, columns, order_by).withColumnsRenamed(
        {n: f"__new_{n}" for n in columns}
    )
    joined = dim.join(latest, key, "left")
    return joined.select(
        *[F.coalesce(f"__new_{c}", c).alias(c) if c in columns else F.col(c) for c in dim.columns]
    )


def changed_members(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``after`` rows that differ from the same member's ``before`` row in one of the columns."""
    old = before.select(key, *[F.col(c).alias(f"__old_{c}") for c in columns])
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__old_{c}"))
    return after.join(old, key).filter(differs).select(*after.columns)


def users_with_updates(events: DataFrame, order_by: Sequence[str], page: str = PLAY_PAGE) -> DataFrame:
    """:func:`update_users` of the users that the same events give, in one pass over the events."""
    played = F.max(F.col("page").eqNullSafe(page)).alias("__played")
    versions = _versions(events.filter("userid IS NOT NULL"), ["userid"], list(USER_COLUMNS.values()), order_by, played)
    ranked = F.struct("__order", *[F.col(s).alias(f"__{n}") for n, s in USER_COLUMNS.items()])
    first = [F.min(F.when(F.col("__played"), F.col(s))).alias(f"__first_{n}") for n, s in USER_COLUMNS.items()]
    users = versions.groupBy(F.col("userid").alias("user_id")).agg(
        F.max(ranked).alias("__last"), F.max("__played").alias("__played"), *first
    )
    return users.filter("__played").select("user_id", *[F.coalesce(f"__last.__{n}", f"__first_{n}").alias(n) for n in USER_COLUMNS])


def update_users(users: DataFrame, events: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Users with their latest attributes; events of every page count."""
    return upsert_latest(users, events, "userid", "user_id", USER_COLUMNS, order_by)
