"""High-water marks: take only rows newer than what the target already holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from .lookup import match_unique


def high_water_mark(state: DataFrame, time: str, name: str = "latest") -> DataFrame:
    """The latest time of the stored state, as one row."""
    return state.agg(F.max(time).alias(name))


def high_water_marks(state: DataFrame, time: str, by: Sequence[str], name: str = "latest") -> DataFrame:
    """The latest time per key."""
    return state.groupBy(*by).agg(F.max(time).alias(name))


def read_mark(state: DataFrame | None, time: str) -> Column | None:
    """The mark as a literal of the column's own type; None without state or without any time in it.

    Read before the batch is planned, so that the filter on it can be pushed to the scan
    and the plan never reads the target it is about to extend.  The value never becomes a datetime
    of Python, which would be moved by the zone of the driver's machine: times with a zone come as
    microseconds, everything else as Spark's own text.
    """
    if state is None:
        return None
    latest = F.max(time)
    kind = state.schema[time].dataType
    if isinstance(kind, TimestampType):
        value = state.agg(F.unix_micros(latest)).first()[0]
        return None if value is None else F.timestamp_micros(F.lit(value))
    value = state.agg(latest.cast("string")).first()[0]
    return None if value is None else F.lit(value).cast(kind)


def newer_than(df: DataFrame, time: str, mark: Column | int | float | str | None) -> DataFrame:
    """Rows strictly after the mark (``read_mark``, or a plain value); all rows when there is no mark.

    With a mark, rows whose time is null are left out.
    """
    return df if mark is None else df.filter(F.col(time) > mark)


def newer_than_per_key(df: DataFrame, time: str, marks: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """Rows strictly after their own key's mark; a key without a mark keeps all its rows."""
    if marks is None:
        return df
    (mark,) = (column for column in marks.columns if column not in by)
    marked = match_unique(df, marks.withColumnRenamed(mark, "__mark"), by, "left")
    return marked.filter(F.col("__mark").isNull() | (F.col(time) > F.col("__mark"))).select(*df.columns)
