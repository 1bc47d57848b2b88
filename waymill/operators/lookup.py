"""Joins to a side that holds at most one row per key, and name lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The largest number of partitions there can be: coalescing to it merges nothing.
_NO_MERGE = (1 << 31) - 1


def match_unique(left: DataFrame, unique: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join many rows to the one row per key that an aggregation has made.

    An aggregated side is already partitioned by its key, and Spark would reuse
    that partitioning for the join.  Then one hot key of ``left`` ends in one task,
    because adaptive execution splits a skewed partition only where both sides
    come straight from the join's own shuffle.  ``coalesce`` moves no row here; it makes
    Spark forget the partitioning, and so shuffle the (much smaller) unique side once more.

    No side is marked for broadcast: Spark does that by itself when its statistics
    (or, at run time, the measured shuffle size) are below the configured limit.
    """
    return left.join(unique.coalesce(_NO_MERGE), list(on), how)


def distinct_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct rows; duplicates go before the shuffle, by hash, within each task."""
    return pairs.dropDuplicates()


def one_name_per_code(pairs: DataFrame, code: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per code: the smallest of its names.

    A code with two names would otherwise multiply the rows of every lookup.
    Duplicates go first, in a hash table per task; only distinct pairs are left to be
    sorted and ranked.  (A text minimum would sort every row: Catalyst drops a
    distinct below it as redundant.)
    """
    keys = [code, *by]
    pairs = distinct_pairs(pairs.select(*keys, name))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last(name)))
    return pairs.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def attach_name(
    df: DataFrame, names: DataFrame, code: str, as_name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Left lookup of one code column in a table (…by, code, name) that is unique per code.

    Call it once per role of the code.  The row count never changes, and an unknown code gives null.
    Where ``names`` is a stored table (see ``storage.materialize``), its true size decides
    already at planning whether it is broadcast.
    """
    name_code, name = (column for column in names.columns if column not in by)
    role = names.select(*by, F.col(name_code).alias(code), F.col(name).alias(as_name))
    return match_unique(df, role, [code, *by], "left")
