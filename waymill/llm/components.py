"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import match_unique
from ..storage import materialize, new_folder


def connected_components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of the edges (``a``, ``b``): the least node that can be reached.

    Labels move along the edges and then jump to their own label's label, so that chains shorten fast.
    Each step is stored, which cuts the lineage; only the number of changes comes to the driver.
    """
    spark = edges.sparkSession
    both = edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.dropDuplicates(), new_folder(spark, "edges"))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component"))
    labels = materialize(labels, new_folder(spark, "labels"))
    while True:
        sent = match_unique(both, labels.select(F.col("node").alias("a"), "component"), ["a"])
        near = sent.groupBy(F.col("b").alias("node")).agg(F.min("component").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("at"))
        ahead = labels.select(F.col("node").alias("at"), F.col("component").alias("then"))
        moved = match_unique(moved, ahead, ["at"], "left")
        moved = moved.select("node", "old", F.least("at", F.coalesce("then", "at")).alias("component"))
        moved = materialize(moved, new_folder(spark, "labels"))
        labels = moved.drop("old")
        if moved.filter("component <> old").isEmpty():
            return labels
