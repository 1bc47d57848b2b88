"""Missing values: drop empty rows; fill by mean, zero or most frequent value.

Fill values come from uncorrelated scalar subqueries.  Spark computes all means
of one table in one pass, runs each subquery once and puts its value in as a
literal, so that no join is needed and nothing passes through the caller.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    absent = [name for name in columns if name not in df.columns]
    if absent:
        raise ValueError(f"columns missing from the input: {', '.join(absent)}")


# A time of day, with or without seconds, and the offset after it.
_OFFSET = r"^(.*\d:\d{2}(?::\d{2}(?:\.\d+)?)?) ?(Z|[+-]\d{2}:?\d{2})$"


def wall_time(text: Column | str, zone: str = "UTC") -> Column:
    """Text as a timestamp without zone.

    A time with an offset (``Z``, ``+09:00``, ``+0900``) is an instant and is given as the time it was in
    ``zone``; one without stays as it is written.  Unreadable text gives null.  Neither the
    session's nor the driver's zone plays a part.
    """
    text = F.trim(F.col(text) if isinstance(text, str) else text)
    offset = F.regexp_extract(text, _OFFSET, 2)
    local = F.when(offset == "", text).otherwise(F.regexp_extract(text, _OFFSET, 1)).try_cast("timestamp_ntz")
    digits = F.regexp_replace(offset, "[^0-9]", "")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    minutes = F.when(offset == "Z", 0).when(offset.startswith("-"), -minutes).otherwise(minutes)
    moved = F.convert_timezone(F.lit("UTC"), F.lit(zone), local - F.make_dt_interval(mins=minutes))
    return F.when(offset == "", local).otherwise(moved)


def typed_readings(df: DataFrame, numbers: Sequence[str], time: str | None = None, zone: str = "UTC") -> DataFrame:
    """Text readings as doubles and, for ``time``, as a timestamp without zone (``wall_time``).

    Unreadable text becomes null, and so does NaN, which would otherwise spoil the mean.
    """
    require_columns(df, [*numbers, *([time] if time else [])])
    converted = {name: F.col(name).try_cast("double") for name in numbers}
    converted = {name: F.when(~F.isnan(number), number) for name, number in converted.items()}
    if time:
        converted[time] = wall_time(time, zone)
    return df.withColumns(converted)


def drop_all_null(df: DataFrame, tags: Sequence[str] = ()) -> DataFrame:
    """Drop rows in which every column is null, not counting the tag columns that the reader added."""
    return df.dropna("all", subset=[name for name in df.columns if name not in tags])


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The means of several columns in one row, by one pass."""
    return df.agg(*(F.avg(name).alias(name) for name in columns))


def fill_mean(df: DataFrame, columns: Sequence[str], means: Mapping[str, Column] | None = None) -> DataFrame:
    """Nulls replaced by the column's mean over this batch (a mean of 0.0 counts too).

    A column without any value stays null.  ``means`` spares the pass over the batch where its means are known, as from
    the write that has stored it.
    """
    require_columns(df, columns)
    means = {name: df.agg(F.avg(name)).scalar() if means is None else means[name] for name in columns}
    return df.withColumns({name: F.coalesce(F.col(name), mean) for name, mean in means.items()})


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by 0, in text columns by '0'."""
    require_columns(df, columns)
    zeros = {name: F.lit(0).cast(df.schema[name].dataType) for name in columns}
    return df.withColumns({name: F.coalesce(F.col(name), zero) for name, zero in zeros.items()})


def most_frequent(df: DataFrame, column: str, ignore_nulls: bool = False, count: str = "n") -> DataFrame:
    """The value with the most rows and their number; null is a value like any other unless ignored.

    Of values with equally many rows the smallest is taken, null first.
    """
    rows = df.filter(F.col(column).isNotNull()) if ignore_nulls else df
    counts = rows.groupBy(column).agg(F.count("*").alias(count))
    return counts.orderBy(F.desc(count), F.asc_nulls_first(column)).limit(1)


def fill_mode(df: DataFrame, columns: Sequence[str], ignore_nulls: bool = False) -> DataFrame:
    """Nulls replaced by the most frequent value; when that is null, nothing is filled."""
    require_columns(df, columns)
    modes = {name: most_frequent(df, name, ignore_nulls).select(name).scalar() for name in columns}
    return df.withColumns({name: F.coalesce(F.col(name), mode) for name, mode in modes.items()})
