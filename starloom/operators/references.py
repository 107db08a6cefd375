"""Declared keys and references of several tables, checked in one pass over each table.

The key columns of a referring table are unpivoted to one stream of (reference, key), the members of the referenced
tables join the same stream, and one aggregate per reference and key says how many rows refer to how many members. A key
that most rows hold arrives as one row per task, a wide fact is read once however many references it has, and no join is
needed at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.schemas import Table


@dataclass(frozen=True)
class Reference:
    table: str
    column: str
    parent: str


def declared(tables: Mapping[str, Table]) -> list[Reference]:
    """The references that the table definitions name."""
    return [Reference(t.name, column, parent) for t in tables.values() for column, parent in t.references.items()]


def _named(values: Sequence[str], index: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[index]


def key_counts(
    children: Mapping[str, DataFrame], parents: Mapping[str, tuple[DataFrame, str]], references: Sequence[Reference]
) -> DataFrame:
    """``ref`` (place in ``references``), the key, ``n`` referring rows and ``m`` members, for every key on either side.

    ``parents`` maps a name to ``(table, key)``. Each referenced table has a key column of its own type, named after it;
    of these all are NULL but the reference's. Rows without a key have NULL there and never a member. Every reference
    has at least one row.
    """
    used = [p for p in parents if any(r.parent == p for r in references)]
    kinds = {p: parents[p][0].schema[parents[p][1]].dataType for p in used}

    def entry(ref: int, parent: str, key: str) -> str:
        keys = [f"CAST({f'`{key}`' if p == parent else 'NULL'} AS {kinds[p].simpleString()}) AS `key_{p}`" for p in used]
        return f"struct({ref} AS ref, {', '.join(keys)})"

    def stream(frame: DataFrame, entries: Sequence[str], n: int, m: int) -> DataFrame:
        return frame.selectExpr(f"inline(array({', '.join(entries)}))").selectExpr("*", f"{n}L AS n", f"{m}L AS m")

    streams = []
    for name, child in children.items():
        entries = [entry(i, r.parent, r.column) for i, r in enumerate(references) if r.table == name]
        if entries:
            streams.append(stream(child, entries, 1, 0))
    for name in used:
        frame, key = parents[name]
        entries = [entry(i, name, key) for i, r in enumerate(references) if r.parent == name]
        streams.append(stream(frame.select(F.col(key)).dropna(), entries, 0, 1))
    nothing = [f"CAST(NULL AS {kinds[p].simpleString()}) AS `key_{p}`" for p in used]
    spark = streams[0].sparkSession
    streams.append(spark.range(0, len(references), 1, 1).selectExpr("CAST(id AS int) AS ref", *nothing, "0L AS n", "0L AS m"))
    keys = ["ref", *[f"key_{p}" for p in used]]
    return reduce(DataFrame.union, streams).groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def _has_key(counts: DataFrame) -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in counts.columns if c.startswith("key_")]).isNotNull()


def joined_counts(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(dimension, fact_rows, joined_rows)``: the inner joins of the fact with each dimension, counted in one pass.

    ``dims`` maps a name to ``(dimension, key)``; the fact's column has the same name as the key.
    """
    references = [Reference("fact", key, name) for name, (_, key) in dims.items()]
    totals = key_counts({"fact": fact}, dims, references).groupBy("ref").agg(
        F.sum("n").alias("fact_rows"), F.sum(F.col("n") * F.col("m")).alias("joined_rows")
    )
    return totals.select(_named(list(dims), F.col("ref")).alias("dimension"), "fact_rows", "joined_rows")


def foreign_keys(
    children: Mapping[str, DataFrame], parents: Mapping[str, tuple[DataFrame, str]], references: Sequence[Reference]
) -> DataFrame:
    """One row per reference: rows and distinct keys that refer, and those among them that no member has.

    Rows with a NULL key refer to nothing: they are counted in ``n_nulls`` alone.
    """
    counts = key_counts(children, parents, references)
    key, orphan = _has_key(counts), F.col("m") == 0
    totals = counts.groupBy("ref").agg(
        F.coalesce(F.sum(F.when(key, F.col("n"))), F.lit(0)).alias("n_rows"),
        F.count_if(key & (F.col("n") > 0)).alias("n_keys"),
        F.coalesce(F.sum(F.when(~key, F.col("n"))), F.lit(0)).alias("n_nulls"),
        F.coalesce(F.sum(F.when(key & orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(key & orphan & (F.col("n") > 0)).alias("orphan_keys"),
    )
    labels = {f: [getattr(r, f) for r in references] for f in ("table", "column", "parent")}
    return totals.select(
        *[_named(labels[f], F.col("ref")).alias(name) for f, name in (("table", "table_name"), ("column", "column_name"), ("parent", "parent_name"))],
        *[c for c in totals.columns if c != "ref"],
    )


def orphan_keys(
    children: Mapping[str, DataFrame], parents: Mapping[str, tuple[DataFrame, str]], references: Sequence[Reference]
) -> DataFrame:
    """``(table_name, column_name, key, n)`` of every key that refers to no member; ``key`` is its text."""
    counts = key_counts(children, parents, references)
    text = F.coalesce(*[F.col(c).cast("string") for c in counts.columns if c.startswith("key_")])
    found = counts.select("ref", text.alias("key"), "n", "m").filter("m = 0 AND n > 0 AND key IS NOT NULL")
    return found.select(
        _named([r.table for r in references], F.col("ref")).alias("table_name"),
        _named([r.column for r in references], F.col("ref")).alias("column_name"),
        "key",
        "n",
    )


def primary_keys(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per table: its rows, NULL keys, distinct keys, and keys that occur more than once.

    ``tables`` maps a name to ``(table, key)``. Only a hash of each key is shuffled. Where no hash of a table occurs
    twice, its keys are unique for certain; only the rows of hashes that do are read again and compared by their keys.
    """
    names = list(tables)

    def stream(which: Sequence[str]) -> DataFrame:
        parts = []
        for name in which:
            frame, key = tables[name]
            text = F.col(key).cast("string")
            parts.append(frame.select(F.lit(names.index(name)).alias("t"), F.when(text.isNotNull(), F.xxhash64(key)).alias("h"), text.alias("key")))
        return reduce(DataFrame.unionByName, parts)

    hashed = stream(names).groupBy("t", "h").agg(F.count(F.lit(1)).alias("n"))
    present = F.col("h").isNotNull()
    totals = hashed.groupBy("t").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("n_nulls"),
        F.count_if(present & (F.col("n") == 1)).alias("single"),
        F.count_if(present & (F.col("n") > 1)).alias("shared"),
    )
    found = {r.t: r for r in totals.collect()}  # one row per table
    doubtful = [name for i, name in enumerate(names) if i in found and found[i].shared]
    exact = {}
    if doubtful:
        shared = hashed.filter(present & (F.col("n") > 1)).select("t", "h")
        keys = stream(doubtful).join(shared, ["t", "h"], "left_semi").groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"))
        counted = keys.groupBy("t").agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("n") > 1).alias("n_duplicated"))
        exact = {r.t: (r.n_keys, r.n_duplicated) for r in counted.collect()}
    rows = []
    for i, name in enumerate(names):
        r, (n_keys, n_duplicated) = found.get(i), exact.get(i, (0, 0))
        rows.append((name, tables[name][1], *((r.n_rows, r.n_nulls, r.single + n_keys) if r else (0, 0, 0)), n_duplicated))
    schema = "table_name string, column_name string, n_rows bigint, n_nulls bigint, n_keys bigint, n_duplicated bigint"
    return tables[names[0]][0].sparkSession.createDataFrame(rows, schema)
