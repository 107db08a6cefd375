"""Times every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from starloom.plans.catalog import QUERIES
from starloom.session import configure

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(spark: SparkSession, name: str) -> float:
    """Seconds to plan the query and compute all its rows."""
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        configure(SparkSession.builder.master(f"local[{CPUS}]").appName("starloom-bench"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)
    run(spark, "plays_by_week_level")  # warm-up: class loading and code generation
    seconds = {name: round(run(spark, name), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
