"""The seven tables in Spark's catalog: create, drop, load, append, replace, clear, write layout."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from starloom.schemas import DAY, MAX_TEXT, Table, star_tables

VERSION = "version-"  # each table folder holds one folder per version of the table
NEXT_ID = "starloom.next_id"
REJECTS = "rejects"  # column of staged files that holds values without a place
REJECTS_TABLE = "staging_rejects"
FILE_BYTES = 256 << 20  # of a stored file, about
FILE_NAME = "mapreduce.output.basename"  # writer option: how names of written files begin


def _column_list(schema: StructType) -> str:
    kinds = [
        f"VARCHAR({MAX_TEXT})" if isinstance(f.dataType, StringType) else f.dataType.simpleString().upper()
        for f in schema.fields
    ]
    return ", ".join(f"`{name}` {kind}" for name, kind in zip(schema.names, kinds))


def _quoted(text: str) -> str:
    return text.replace("'", "\\'")


def _create(spark: SparkSession, database: str, table: Table, table_folder: str) -> None:
    columns, partitioned = _column_list(table.schema), ""
    if table.day_of:
        columns, partitioned = f"{columns}, {DAY} DATE", f"PARTITIONED BY ({DAY})"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{table.name}` ({columns}) USING parquet {partitioned} "
        f"LOCATION '{_quoted(f'{table_folder}/{VERSION}{uuid.uuid4().hex}')}'"
    )


def create_tables(
    spark: SparkSession, database: str, root: str, tables: Mapping[str, Table] | None = None
) -> None:
    """Create what is missing, referenced tables first. Each table starts in an empty folder of its own under ``root``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for table in (tables or star_tables()).values():
        _create(spark, database, table, f"{root.rstrip('/')}/{table.name}")


def drop_tables(spark: SparkSession, database: str, tables: Mapping[str, Table] | None = None) -> None:
    """Drop all tables, referring tables first. The files of dropped tables stay for whoever keeps the storage."""
    for name in ["load_ledger", REJECTS_TABLE, *reversed(list(tables or star_tables()))]:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")


def load(spark: SparkSession, database: str, name: str) -> DataFrame:
    """The rows of a table, in the columns of its schema."""
    return spark.table(f"`{database}`.`{name}`").drop(DAY)


def load_between(
    spark: SparkSession, database: str, name: str, column: str, low: datetime, high: datetime
) -> DataFrame:
    """Rows of a table divided by the day of ``column``, from ``low`` to ``high``; only those days are listed and read."""
    stored = spark.table(f"`{database}`.`{name}`")
    days = F.col(DAY).between(F.lit(low.date()), F.lit(high.date()))
    low_ts, high_ts = (F.lit(str(t)).cast("timestamp_ntz") for t in (low, high))
    return stored.filter(days & F.col(column).between(low_ts, high_ts)).drop(DAY)


def lay_out(df: DataFrame, sort_by: Sequence[str], n_partitions: int | None = None) -> DataFrame:
    """Even, sorted files: ranges of the whole sort key, sorted inside, so that Parquet statistics can skip data.

    The range covers every sort column, so one hot leading value still spreads over many partitions. Without
    ``n_partitions`` the session's shuffle setting decides and adaptive execution merges small partitions.
    """
    ranged = (
        df.repartitionByRange(*sort_by) if n_partitions is None else df.repartitionByRange(n_partitions, *sort_by)
    )
    return ranged.sortWithinPartitions(*sort_by)


def files_for(n_bytes: int, file_bytes: int = FILE_BYTES) -> int:
    """How many files hold ``n_bytes``."""
    return max(1, -(-n_bytes // file_bytes))


def append(df: DataFrame, database: str, name: str, n_files: int | None = None) -> None:
    """Add rows; columns are matched by name. Text beyond the declared length fails the write.

    Rows of a table divided by day are sorted by day and sort key inside each task: one open file at a time, in order.
    With ``n_files`` they are first divided into so many ranges of day and sort key, so that a batch adds at most
    ``n_files`` files and one more for each of its days, and a large day is cut into files that do not overlap.
    """
    full_name = f"`{database}`.`{name}`"
    table = star_tables()[name]
    rows = df
    if table.day_of:
        rows = df.withColumn(DAY, F.to_date(table.day_of))
        if n_files:
            rows = rows.repartitionByRange(n_files, DAY, *table.sort_by)
        rows = rows.sortWithinPartitions(DAY, *table.sort_by)
    rows.select(*df.sparkSession.table(full_name).columns).write.insertInto(full_name, overwrite=False)


def append_files(df: DataFrame, database: str, name: str, tag: str) -> None:
    """:func:`append` for a table without days, in files whose names begin with ``tag``."""
    spark = df.sparkSession
    if star_tables()[name].day_of:
        raise ValueError(f"{name} is divided by day")
    rows = _checked(df, load(spark, database, name).columns)
    rows.write.mode("append").option(FILE_NAME, tag).parquet(location(spark, database, name))
    spark.catalog.refreshTable(f"`{database}`.`{name}`")


def remove_files(spark: SparkSession, folder: str, tag: str) -> None:
    """Delete the files of a folder whose names begin with ``tag``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path):
        for status in files.listStatus(path):
            if status.getPath().getName().startswith(f"{tag}-"):
                files.delete(status.getPath(), False)


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def table_root(spark: SparkSession, database: str) -> str:
    """The folder below which the tables were created."""
    return location(spark, database, "staging_events").rsplit("/", 2)[0]


def location(spark: SparkSession, database: str, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{name}`")
    return described.filter("col_name = 'Location'").first().data_type


def _checked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns, failing on text beyond the declared length as a catalog insert would."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(
        *[
            F.when(F.char_length(c) > MAX_TEXT, F.raise_error(F.lit(f"{c} exceeds {MAX_TEXT} characters")))
            .otherwise(F.col(c))
            .cast("string")
            .alias(c)
            if c in texts
            else F.col(c)
            for c in columns
        ]
    )


def drop_versions(spark: SparkSession, table_folder: str, keep: set[str]) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(table_folder)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        version = status.getPath().getName()
        if version.startswith(VERSION) and version not in keep:
            files.delete(status.getPath(), True)


def append_rejects(found: DataFrame, database: str, name: str, batch: str, tag: str = "part") -> None:
    """Add rejected values (``column_name``, ``raw_value``, ``reason``) of a table to the rejects table, made if missing.

    The names of the files begin with ``tag``.
    """
    spark = found.sparkSession
    folder = table_root(spark, database)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{REJECTS_TABLE}` (table_name STRING, column_name STRING, raw_value STRING, "
        f"reason STRING, batch STRING) USING parquet PARTITIONED BY (batch) LOCATION '{_quoted(f'{folder}/{REJECTS_TABLE}')}'"
    )
    rows = found.select(F.lit(name).alias("table_name"), "column_name", "raw_value", "reason")
    of_batch = f"{location(spark, database, REJECTS_TABLE)}/batch={batch}"
    rows.write.mode("append").option(FILE_NAME, tag).parquet(of_batch)
    spark.sql(f"ALTER TABLE `{database}`.`{REJECTS_TABLE}` ADD IF NOT EXISTS PARTITION (batch = '{_quoted(batch)}')")
    spark.catalog.refreshTable(f"`{database}`.`{REJECTS_TABLE}`")


def replace(
    df: DataFrame,
    database: str,
    name: str,
    keep_previous: bool = True,
    check_text: bool = True,
    hidden: Sequence[str] = (),
    before_switch: Callable[[str], None] | None = None,
) -> None:
    """Write ``df`` to a new folder, then point the table at it; ``df`` may read the table.

    The switch is one catalog call: readers see the old or the new rows, and a failed write changes nothing. The
    previous version stays until the next replacement for queries that still read it, unless told otherwise.
    ``check_text=False`` is for rows whose text lengths have been checked already. ``hidden`` columns of ``df`` are written
    to the files too, where the table does not show them; ``before_switch`` is called with the new folder, and if it
    fails the folder goes and the table stays.
    """
    spark = df.sparkSession
    if star_tables()[name].day_of:
        raise ValueError(f"{name} is divided by day and only grows; it cannot be replaced")
    full_name = f"`{database}`.`{name}`"
    old = location(spark, database, name)
    table_folder, old_version = old.rsplit("/", 1)
    new_version = VERSION + uuid.uuid4().hex
    new = f"{table_folder}/{new_version}"
    columns = [*spark.table(full_name).columns, *hidden]
    rows = _checked(df, columns) if check_text else df.select(*columns)
    rows.write.mode("errorifexists").parquet(new)
    if before_switch is not None:
        try:
            before_switch(new)
        except Exception:
            drop_versions(spark, table_folder, {old_version})
            raise
    spark.sql(f"ALTER TABLE {full_name} SET LOCATION '{_quoted(new)}'")
    spark.catalog.refreshTable(full_name)
    drop_versions(spark, table_folder, {new_version} | ({old_version} if keep_previous else set()))


def clear(spark: SparkSession, database: str, name: str) -> None:
    """Empty a table."""
    table = star_tables()[name]
    if table.day_of is None:
        replace(load(spark, database, name).limit(0), database, name)
        return
    table_folder = location(spark, database, name).rsplit("/", 1)[0]
    spark.sql(f"DROP TABLE `{database}`.`{name}`")
    _create(spark, database, table, table_folder)


def reserve_ids(spark: SparkSession, database: str, name: str, id_column: str, n: int) -> int:
    """First of ``n`` ids that no row has and no later call gets.

    The next free id is kept with the table and is moved on before any row is written: a load that fails afterwards
    leaves a gap, never a duplicate. A table without the entry is asked for its greatest id once.
    """
    full_name = f"`{database}`.`{name}`"
    kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {full_name}").collect()}
    if NEXT_ID in kept:
        first = int(kept[NEXT_ID])
    else:
        last = load(spark, database, name).agg(F.max(id_column).alias("id")).first().id
        first = 0 if last is None else last + 1
    spark.sql(f"ALTER TABLE {full_name} SET TBLPROPERTIES ('{NEXT_ID}' = '{first + n}')")
    return first
