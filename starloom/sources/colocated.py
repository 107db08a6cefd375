"""A fact kept a second time, divided by one of its keys, next to that key's dimension divided alike.

Both tables are bucketed by the key and a piece number, so their join, and counts by key, read bucket after bucket and
move no row of the fact. A key with more than ``hot_rows`` plays would fill its bucket; its plays are dealt out in pieces
and its member is stored once per piece, in buckets of their own. Plays without a key are spread.

Only columns given to ``create`` are kept: a narrow copy costs less than the shuffle it saves from the second report on.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.skew import HOT_ROWS, NULL_KEY_PIECES, copies, deal, hot_hashes, key_hash
from starloom.sources.tables import VERSION, drop_versions, location

PIECE = "piece"


class Colocated:
    """The plays ``name`` and the members ``name_members`` of a database, both divided by ``key``.

    ``n_buckets`` cannot change once the tables are there; a bucket is what one task reads.
    """

    def __init__(self, spark: SparkSession, database: str, name: str, key: str, n_buckets: int, hot_rows: int = HOT_ROWS):
        self.spark, self.key, self.n_buckets, self.hot_rows = spark, key, n_buckets, hot_rows
        self.plays_table, self.members_table = f"`{database}`.`{name}`", f"`{database}`.`{name}_members`"
        self.database, self.name = database, name

    def create(self, plays: DataFrame, members: DataFrame, folder: str, hot_from: DataFrame | None = None) -> None:
        """Store plays and members (unique by the key) below ``folder``. ``hot_from`` is scanned for frequent keys instead
        of plays that are costly to compute. No column but the key may be on both sides."""
        if clash := set(plays.columns) & set(members.columns) - {self.key}:
            raise ValueError(f"columns of plays and of members: {sorted(clash)}")
        hot = hot_hashes(plays if hot_from is None else hot_from, [self.key], self.hot_rows)
        self._store(self._copied(members, plays, hot), self.members_table, f"{folder}/{self.name}_members/{VERSION}{uuid.uuid4().hex}")
        self._store(self._dealt(plays, hot), self.plays_table, f"{folder}/{self.name}")

    def append(self, plays: DataFrame, hot_from: DataFrame | None = None) -> None:
        """Add plays. A key that has become frequent is split from now on; its earlier plays stay in one piece.

        Members get the new pieces before the plays arrive, so that a reader never finds a play without its member.
        """
        known = self._pieces()
        found = dict(hot_hashes(plays if hot_from is None else hot_from, [self.key], self.hot_rows))
        hot = {h: max(known.get(h, 0), found.get(h, 0)) for h in known.keys() | found.keys()}
        if hot != known:
            self._switch_members(self._members().filter(f"{PIECE} = 0").drop(PIECE), list(hot.items()))
        self._dealt(plays, list(hot.items())).select(*self._plays().columns).write.insertInto(self.plays_table)

    def replace_members(self, members: DataFrame) -> None:
        """Put other members in place, such as users after an update; readers see the old or the new ones."""
        self._switch_members(members, list(self._pieces().items()))

    def joined(self, how: str = "inner") -> DataFrame:
        """Plays with the attributes of their members (``inner`` or ``left``)."""
        return self._plays().join(self._members(), [self.key, PIECE], how).drop(PIECE)

    def counted(self, by: Sequence[str]) -> DataFrame:
        """Plays per combination of members' attributes. Only partial sums of the combinations are shuffled."""
        counts = self._plays().groupBy(self.key, PIECE).agg(F.count(F.lit(1)).alias("n"))
        joined = counts.join(self._members().select(self.key, PIECE, *by), [self.key, PIECE])
        return joined.groupBy(*by).agg(F.sum("n").alias("n"))

    def _plays(self) -> DataFrame:
        return self.spark.table(self.plays_table)

    def _members(self) -> DataFrame:
        return self.spark.table(self.members_table)

    def _pieces(self) -> dict[int, int]:
        """Hash and pieces of the keys that are split; their number is bounded where they are found."""
        split = self._members().filter(f"{PIECE} > 0").groupBy(key_hash([self.key]).alias("h")).agg(F.max(PIECE).alias("last"))
        return {r["h"]: r["last"] + 1 for r in split.collect()}

    def _hot(self, hot: list[tuple[int, int]]) -> DataFrame:
        return F.broadcast(self.spark.createDataFrame(hot, "__hash bigint, __pieces bigint"))

    def _dealt(self, plays: DataFrame, hot: list[tuple[int, int]]) -> DataFrame:
        columns = plays.columns
        piece = F.when(F.col(self.key).isNull(), deal(columns, NULL_KEY_PIECES))
        if hot:
            plays = plays.join(self._hot(hot), key_hash([self.key]) == F.col("__hash"), "left")
            piece = piece.when(F.col("__pieces").isNotNull(), deal(columns, F.col("__pieces")))
        return self._divided(plays.select(*columns, piece.otherwise(F.lit(0)).cast("bigint").alias(PIECE)))

    def _copied(self, members: DataFrame, plays: DataFrame, hot: list[tuple[int, int]]) -> DataFrame:
        # Equal numbers of other types have other hashes, so the key takes the type it has among the plays.
        members = members.withColumn(self.key, F.col(self.key).cast(plays.schema[self.key].dataType)).dropna(subset=[self.key])
        columns = members.columns
        if hot:
            members = members.join(self._hot(hot), key_hash([self.key]) == F.col("__hash"), "left")
            return self._divided(members.select(*columns, copies(F.col("__pieces")).alias(PIECE)))
        return self._divided(members.withColumn(PIECE, F.lit(0).cast("bigint")))

    def _divided(self, rows: DataFrame) -> DataFrame:
        """One task per bucket, so that a write adds one file to each."""
        return rows.repartition(self.n_buckets, self.key, PIECE).sortWithinPartitions(self.key, PIECE)

    def _store(self, rows: DataFrame, table: str, folder: str) -> None:
        writer = rows.write.format("parquet").bucketBy(self.n_buckets, self.key, PIECE).sortBy(self.key, PIECE)
        writer.option("path", folder).saveAsTable(table)

    def _switch_members(self, members: DataFrame, hot: list[tuple[int, int]]) -> None:
        """Write members to a new folder under a name for the time being, then point the table at it."""
        old_folder, old_version = location(self.spark, self.database, f"{self.name}_members").rsplit("/", 1)
        version = VERSION + uuid.uuid4().hex
        rows = self._copied(members, self._plays(), hot).select(*self._members().columns)
        passing = f"`{self.database}`.`{self.name}_{version.replace('-', '_')}`"
        self._store(rows, passing, f"{old_folder}/{version}")
        self.spark.sql(f"ALTER TABLE {self.members_table} SET LOCATION '{old_folder}/{version}'")
        self.spark.sql(f"DROP TABLE {passing}")  # its files stay
        self.spark.catalog.refreshTable(self.members_table)
        drop_versions(self.spark, old_folder, {version, old_version})
