"""Load-time conversion from JSON text to declared types, loud about values that do not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from starloom.schemas import MAX_TEXT


def _has_text(raw: Column) -> Column:
    return F.coalesce(F.trim(raw) != "", F.lit(False))


def convert(raw: Column, kind: DataType) -> Column:
    """Text as is; anything else by cast, where empty text means NULL and unusable text becomes NULL."""
    if isinstance(kind, StringType):
        return raw
    return F.nullif(F.trim(raw), F.lit("")).try_cast(kind)


def is_rejected(raw: Column, kind: DataType) -> Column:
    """True where the value cannot be stored: unusable text for a typed column, or text beyond the declared length."""
    if isinstance(kind, StringType):
        return F.coalesce(F.char_length(raw) > MAX_TEXT, F.lit(False))
    return _has_text(raw) & convert(raw, kind).isNull()


def json_value(document: Column, path: str) -> Column:
    """Value at a path of a JSON text column, as text."""
    return F.get_json_object(document, path)
