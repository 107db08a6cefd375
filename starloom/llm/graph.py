"""Connected components by smallest id, with joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import discard, materialize, work_folder


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node it can reach) of all nodes in ``edges`` (``a``, ``b``).

    Each round takes the smallest label of the neighbours and then the label of that label, so a path shortens to less
    than half. Labels are written to the shared folder each round; only the number of changes comes to the driver.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, work_folder(spark))
    folder = work_folder(spark)
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), folder)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("via")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        new = step.join(jump, "via").select("node", F.least("via", "far").alias("label"), (F.col("was") != F.least("via", "far")).alias("moved"))
        old, folder = folder, work_folder(spark)
        new = materialize(new, folder)
        discard(spark, old)
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            return labels
