"""A bitmap of fixed size over the keys of one side, to leave out rows of the other side before they are shuffled.

Tasks mark the hash of each key, an aggregate merges the marks, and the merged words are broadcast: at most ``WORDS`` rows
of 12 bytes, whatever the number of keys. A key that is there always passes; one that is not passes by chance, as often
as marked bits are among all bits. The join itself still decides, so the result does not depend on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 19  # of 64 bits: 33 million keys leave every second other row, three million one in ten


def _place(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(WORDS * 64))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))


def key_bitmap(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``word`` and ``bits`` of the keys of ``df``."""
    place = _place(keys)
    marked = df.select(F.shiftright(place, 6).cast("int").alias("word"), _bit(place).alias("bit"))
    return marked.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def maybe_in(df: DataFrame, keys: Sequence[str], bitmap: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key the bitmap may hold. Key types must be those that the bitmap was made from."""
    names = {"word": "__word", "bits": "__bits"}
    place = _place(keys)
    near = df.join(F.broadcast(bitmap.withColumnsRenamed(names)), F.shiftright(place, 6).cast("int") == F.col("__word"))
    return near.filter(F.col("__bits").bitwiseAND(_bit(place)) != 0).drop(*names.values())
