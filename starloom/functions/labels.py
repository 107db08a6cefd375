"""CASE-shaped expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.schemas import UNKNOWN_SONG_ID


def decode(value: Column, labels: Mapping, default: str = "????") -> Column:
    """Simple CASE: the label of a code, ``default`` for codes without one."""
    result = None
    for code, label in labels.items():
        result = (F if result is None else result).when(value == F.lit(code), F.lit(label))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def song_category(song_id: Column) -> Column:
    """'Unknown' for the unknown member, otherwise 'Known'."""
    return F.when(song_id == UNKNOWN_SONG_ID, F.lit("Unknown")).otherwise(F.lit("Known"))
