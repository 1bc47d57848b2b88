"""Positions in a sorted order, counted without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize, new_folder


def with_position(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows of each group from 1, in the given order, as column ``name``.

    A group may hold any share of the rows: rows go to ranges of (group, order), so that a large
    group spans many tasks; each range counts its own rows, and the counts of the ranges before it
    (one small row per range and group) are added up.  The ranges are stored first, which
    keeps them the same for both passes.  Rows equal in the whole order are interchangeable.
    ``by`` columns must not be null.
    """
    placed = df.repartitionByRange(*(F.col(b) for b in by), *order)
    placed = placed.withColumn("__range", F.spark_partition_id())
    placed = materialize(placed, new_folder(df.sparkSession, "ranges"))
    groups = ["__range", *by]
    counts = placed.groupBy(*groups).agg(F.count("*").alias("__rows"))
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows")
    local = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    counted = placed.withColumn("__local", local).join(counts, groups)
    return counted.withColumn(name, F.col("__before") + F.col("__local")).drop("__range", "__local", "__before")
