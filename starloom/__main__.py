"""``python -m starloom create|load|drop DATABASE …``: the tables and the batch load from a command line."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from starloom.plans.load import run_load
from starloom.session import configure
from starloom.sources.tables import create_tables, drop_tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="starloom", description=__doc__)
    steps = top.add_subparsers(dest="step", required=True)
    create = steps.add_parser("create", help="drop and create the seven tables")
    create.add_argument("database")
    create.add_argument("root", help="folder that holds the tables")
    create.add_argument("--keep", action="store_true", help="keep tables that are there")
    steps.add_parser("drop", help="drop the tables; files stay").add_argument("database")
    load = steps.add_parser("load", help="stage two JSON collections and build the star")
    load.add_argument("database")
    load.add_argument("events", help="prefix of the event files")
    load.add_argument("songs", help="prefix of the song files")
    load.add_argument("--paths-file", help="JSON paths of the event columns, one by one")
    load.add_argument("--skip-staging", action="store_true")
    load.add_argument("--skip-dwh", action="store_true")
    load.add_argument("--skip-count", action="store_true")
    load.add_argument("--append", action="store_true", help="add to what is staged instead of replacing it")
    load.add_argument("--once", action="store_true", help="with --append: stage each file once, and undo failed loads")
    load.add_argument("--keep-rejects", action="store_true", help="set values that do not fit aside instead of failing")
    load.add_argument("--max-rejects", type=int, help="fail beyond so many of them")
    return top


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    given = parser().parse_args(arguments)
    spark = spark or configure(SparkSession.builder.appName(f"starloom-{given.step}")).enableHiveSupport().getOrCreate()
    if given.step == "create":
        if not given.keep and spark.catalog.databaseExists(given.database):
            drop_tables(spark, given.database)
        create_tables(spark, given.database, given.root)
    elif given.step == "drop":
        drop_tables(spark, given.database)
    else:
        result = run_load(
            spark,
            given.database,
            given.events,
            given.songs,
            skip_staging=given.skip_staging,
            skip_dwh=given.skip_dwh,
            skip_count=given.skip_count,
            staging_mode="append" if given.append else "overwrite",
            on_reject="null" if given.keep_rejects else "fail",
            event_paths_file=given.paths_file,
            max_rejects=given.max_rejects,
            once=given.once,
        )
        for row in [*result.before, *result.after]:
            print(f"{row.tag}: {row.table_name} {row.n}")
        for batch, name in result.undone:
            print(f"undone: {name} of {batch}")
        for name, n in result.files.items():
            print(f"files: {name} {n}")
        for name, n in result.rejected.items():
            print(f"rejected: {name} {n}")
        print(f"seconds: {result.seconds:.1f}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
