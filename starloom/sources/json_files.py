"""Reading JSON collections into typed staging frames."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from starloom.functions.conversion import convert, is_rejected
from starloom.schemas import EVENT_PATHS, STAGING_EVENTS, staging_songs

_STEP = re.compile(r"\['([^']+)'\]|\.([A-Za-z_][A-Za-z0-9_]*)|\[(\d+)\]")
_GLOB = re.compile(r"[*?\[\]{}\\]")  # what a path must not mean as a pattern
CORRUPT = "corrupt_record"


def resolve_source(prefix: str) -> str:
    """Glob for everything whose name starts with ``prefix``, as a listing by key prefix would find it.

    Use it with ``recursiveFileLookup``. Spark skips names that start with ``_`` or ``.``.
    """
    return prefix if any(c in prefix for c in "*?[{") else prefix + "*"


def path_steps(path: str) -> list[str | int]:
    """Field names and array places of a JSON path such as ``$['a']['b']``, ``$.a.b`` or ``$['a'][0]``."""
    steps: list[str | int] = []
    pos = 1
    while path.startswith("$") and pos < len(path):
        found = _STEP.match(path, pos)
        if found is None:
            break
        steps.append(int(found.group(3)) if found.group(3) else found.group(1) or found.group(2))
        pos = found.end()
    if not steps or pos < len(path) or isinstance(steps[0], int):
        raise ValueError(f"unsupported JSON path: {path}")
    return steps


def read_paths_file(spark: SparkSession, path: str) -> list[str]:
    """The path expressions of a ``{"jsonpaths": [...]}`` file."""
    found = spark.read.schema("jsonpaths array<string>").option("multiLine", "true").json(path).first()
    if found is None or found.jsonpaths is None:
        raise ValueError(f"no jsonpaths in {path}")
    return list(found.jsonpaths)


def by_position(paths: Sequence[str], schema: StructType) -> dict[str, str]:
    """Pair path expressions with columns one by one."""
    if len(paths) != len(schema.names):
        raise ValueError(f"{len(paths)} paths for {len(schema.names)} columns")
    return dict(zip(schema.names, paths))


def by_name(schema: StructType) -> dict[str, str]:
    """Each column from the field of the same name (case matters)."""
    return {name: f"$['{name}']" for name in schema.names}


def _tree_type(rests: Sequence[Sequence[str | int]], above: str) -> DataType:
    """Type of the value that the remaining steps of some paths start from; text where a path ends."""
    if [] in rests:
        if any(rests):
            raise ValueError(f"{above} is both a value and something that holds values")
        return StringType()
    kinds = {type(steps[0]) for steps in rests}
    if len(kinds) > 1:
        raise ValueError(f"{above} is both an object and an array")
    if kinds == {int}:
        return ArrayType(_tree_type([steps[1:] for steps in rests], f"{above}[]"))
    children: dict[str, list[Sequence[str | int]]] = {}
    for steps in rests:
        children.setdefault(steps[0], []).append(steps[1:])
    return StructType([StructField(name, _tree_type(rest, f"{above}['{name}']")) for name, rest in children.items()])


def path_schema(mapping: Mapping[str, str]) -> StructType:
    """Schema that reads every path of ``mapping`` as text, so that numbers keep their spelling and nothing is inferred."""
    return _tree_type([path_steps(path) for path in dict.fromkeys(mapping.values())], "$")


def _at(document: Column, steps: Sequence[str | int]) -> Column:
    """The value at the end of a path; NULL where a step leads nowhere."""
    for step in steps:
        document = F.get(document, step) if isinstance(step, int) else document.getField(step)
    return document


def read_text_columns(
    spark: SparkSession,
    prefix: str,
    mapping: Mapping[str, str],
    mode: str = "FAILFAST",
    files: Sequence[str] | None = None,
) -> DataFrame:
    """One text column per entry of ``mapping`` (column -> JSON path), from all files under a prefix, or from ``files``."""
    paths = resolve_source(prefix) if files is None else [_GLOB.sub(r"\\\g<0>", f) for f in files]
    raw = (
        spark.read.schema(path_schema(mapping))
        .option("mode", mode)
        .option("recursiveFileLookup", "true")
        .json(paths)
    )
    columns = []
    for column, path in mapping.items():
        first, *rest = path_steps(path)
        columns.append(_at(F.col(f"`{first}`"), rest).alias(column))
    return raw.select(*columns)


def parse_text_columns(
    df: DataFrame, document: str, mapping: Mapping[str, str], keep: Sequence[str] = (), corrupt: str = CORRUPT
) -> DataFrame:
    """The columns ``keep``, one text column per entry of ``mapping``, and ``corrupt``, from a column of JSON texts.

    All paths are read in one pass over each text. A text that is not JSON, or that holds another kind of value where a
    path goes through, gives NULL in all columns and stands in ``corrupt``; a NULL text gives NULL everywhere.
    """
    schema = path_schema(mapping)
    if corrupt in schema.names:
        raise ValueError(f"{corrupt} is a field of the documents; name the corrupt column otherwise")
    parsed = F.from_json(
        F.col(document), schema.add(corrupt, StringType()), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    )
    rows = df.select(*keep, parsed.alias("__parsed"))
    sound = F.col(f"__parsed.`{corrupt}`").isNull()
    columns = [F.when(sound, _at(F.col("__parsed"), path_steps(path))).alias(c) for c, path in mapping.items()]
    return rows.select(*keep, *columns, F.col(f"__parsed.`{corrupt}`").alias(corrupt))


def typed(text: DataFrame, schema: StructType) -> DataFrame:
    """Text columns cast to the declared types."""
    return text.select(*[convert(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


REJECT = "struct<column_name: string, raw_value: string, reason: string>"


def with_rejects(text: DataFrame, schema: StructType, name: str = "rejects", keep: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep``, :func:`typed` columns, and an array of the values that could not be stored as they are.

    A rejected value is NULL in its column and stands in the array with its column and the reason: ``not a <type>`` or
    ``too long``.
    """
    columns, rejects = [], []
    for f in schema.fields:
        raw = F.col(f.name)
        bad = is_rejected(raw, f.dataType)
        reason = "too long" if isinstance(f.dataType, StringType) else f"not a {f.dataType.simpleString()}"
        columns.append(F.when(~bad, convert(raw, f.dataType)).alias(f.name))
        rejects.append(F.when(bad, F.struct(F.lit(f.name).alias("column_name"), raw.alias("raw_value"), F.lit(reason).alias("reason"))))
    found = F.array_compact(F.array(*rejects)).cast(f"array<{REJECT}>")
    return text.select(*keep, *columns, found.alias(name))


def rejected_values(rows: DataFrame, name: str = "rejects", keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, column_name, raw_value, reason)`` of every rejected value of :func:`with_rejects`."""
    return rows.select(*keep, F.inline(name))


def read_events(
    spark: SparkSession,
    prefix: str,
    mapping: Mapping[str, str] | None = None,
    schema: StructType = STAGING_EVENTS,
) -> DataFrame:
    """Event collection by explicit path mapping."""
    mapping = mapping or by_position(EVENT_PATHS, schema)
    return typed(read_text_columns(spark, prefix, mapping), schema)


def read_songs(spark: SparkSession, prefix: str, schema: StructType | None = None) -> DataFrame:
    """Song collection by field name."""
    schema = schema or staging_songs()
    return typed(read_text_columns(spark, prefix, by_name(schema)), schema)
