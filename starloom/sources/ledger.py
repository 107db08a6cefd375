"""Which files have been staged by which batch, so that a load can be repeated after a crash and add nothing twice.

The ledger is a table of the database that only grows. Before a batch writes rows of a staging table, the ledger gets one
row (step ``begun``) per file of the batch; after all its rows are stored, one row (``stored``). A file counts as staged if
its batch has been stored; a file that changed (other length or time) is a new file. The files that a batch writes bear
its name, so what a batch left behind that began and was never stored can be found and removed (``undone``).

One load at a time may use a ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.json_files import resolve_source
from starloom.sources.tables import REJECTS_TABLE, location, remove_files, table_root

LEDGER_TABLE = "load_ledger"
_FILE = ["path", "length", "modified"]


def file_tag(batch: str, name: str) -> str:
    """How names of files begin that a batch writes for a staging table."""
    return f"batch-{batch}-{name}"


def source_files(spark: SparkSession, prefix: str) -> DataFrame:
    """``(path, length, modified)`` of the files under a prefix; their contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(resolve_source(prefix))
    return listed.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


@dataclass(frozen=True)
class Ledger:
    spark: SparkSession
    database: str

    @property
    def _name(self) -> str:
        return f"`{self.database}`.`{LEDGER_TABLE}`"

    def create(self) -> Ledger:
        folder = f"{table_root(self.spark, self.database)}/{LEDGER_TABLE}".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name} (batch STRING, table_name STRING, step STRING, path STRING, "
            f"length BIGINT, modified BIGINT) USING parquet LOCATION '{folder}'"
        )
        return self

    def rows(self) -> DataFrame:
        return self.spark.table(self._name)

    def _steps(self, step: str) -> DataFrame:
        return self.rows().filter(F.col("step") == step).select("batch", "table_name").distinct()

    def staged_files(self, name: str) -> DataFrame:
        """Files of a staging table whose rows are stored."""
        begun = self.rows().filter((F.col("step") == "begun") & (F.col("table_name") == name))
        return begun.join(self._steps("stored"), ["batch", "table_name"], "left_semi").select(*_FILE).distinct()

    def begin(self, batch: str, name: str, prefix: str) -> list[str]:
        """Enter the files under a prefix that are not staged yet; returns their paths, as many as the reader would list."""
        new = source_files(self.spark, prefix).join(self.staged_files(name), _FILE, "left_anti")
        entries = new.select(F.lit(batch).alias("batch"), F.lit(name).alias("table_name"), F.lit("begun").alias("step"), *_FILE)
        entries.coalesce(1).write.insertInto(self._name)  # one small row per file
        entered = self.rows().filter((F.col("batch") == batch) & (F.col("table_name") == name) & (F.col("step") == "begun"))
        return sorted(r.path for r in entered.select("path").collect())

    def note(self, batch: str, name: str, step: str) -> None:
        nothing = [F.lit(None).cast(kind) for kind in ("string", "bigint", "bigint")]
        row = self.spark.range(1).coalesce(1).select(F.lit(batch), F.lit(name), F.lit(step), *nothing)
        row.write.insertInto(self._name)

    def undo_unfinished(self) -> list[tuple[str, str]]:
        """Remove what batches left behind that began and were not stored. Returns these (batch, table) pairs."""
        ended = self._steps("stored").union(self._steps("undone"))
        unfinished = self._steps("begun").join(ended, ["batch", "table_name"], "left_anti")
        found = sorted((r.batch, r.table_name) for r in unfinished.collect())  # one a failed load
        for batch, name in found:
            remove_files(self.spark, location(self.spark, self.database, name), file_tag(batch, name))
            self.spark.catalog.refreshTable(f"`{self.database}`.`{name}`")
            if self.spark.catalog.tableExists(f"`{self.database}`.`{REJECTS_TABLE}`"):
                rejects = location(self.spark, self.database, REJECTS_TABLE)
                remove_files(self.spark, f"{rejects}/batch={batch}", file_tag(batch, name))
                self.spark.catalog.refreshTable(f"`{self.database}`.`{REJECTS_TABLE}`")
            self.note(batch, name, "undone")
        return found
