"""Forecast and observed weather: new rows only, missing values filled, appended to the target."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    drop_all_null,
    fill_mean,
    fill_mode,
    fill_zero,
    high_water_marks,
    least_row_per_key,
    match_unique,
    newer_than_per_key,
    read_mark,
    typed_readings,
    union_all,
)
from ..schemas import (
    FORECAST_MODE_FILLED,
    FORECAST_ZERO_FILLED,
    MEAN_FILLED,
    OBSERVED_ZERO_FILLED,
    WEATHER_AIRPORTS,
    WEATHER_FIRST_DAY,
)
from ..sinks import StagedRun, finish_run
from ..sources import (
    FILE,
    FORECAST_FILES,
    OBSERVED_FILES,
    DatedCsv,
    files_by_header,
    paths_of,
    read_backfill,
    read_by_header,
    read_state,
    source_files,
)
from ..storage import materialize, scratch_folder

TIME = "timestamp"
CODE = "airport_code"
_WRITTEN = "__written_time"
# Added to the target's path: the table of rows without a readable time, and that of the files read.
UNDATED = "-undated"
FILES = "-files"
# What tells one state of a file from another.
_VERSION = (FILE, "size", "modified")
_HASH = "content_hash"

_FORECAST_NUMBERS = (*MEAN_FILLED, *FORECAST_ZERO_FILLED, *FORECAST_MODE_FILLED)
_OBSERVED_NUMBERS = (*MEAN_FILLED, *OBSERVED_ZERO_FILLED)


def fill_forecast(
    batch: DataFrame,
    mean: Sequence[str] = MEAN_FILLED,
    zero: Sequence[str] = FORECAST_ZERO_FILLED,
    mode: Sequence[str] = FORECAST_MODE_FILLED,
    means: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Fill by mean, zero and most frequent value of this batch (``means`` if they are known)."""
    return fill_mode(fill_zero(fill_mean(batch, mean, means), zero), mode)


def clean_forecast(batch: DataFrame, *filled: Sequence[str], tags: Sequence[str] = (CODE,)) -> DataFrame:
    """Drop empty rows, then fill (``filled``: the columns of ``fill_forecast``)."""
    return fill_forecast(drop_all_null(batch, tags), *filled)


def clean_observed(
    batch: DataFrame,
    mean: Sequence[str] = MEAN_FILLED,
    zero: Sequence[str] = OBSERVED_ZERO_FILLED,
    means: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Fill by mean and zero of this batch (``means`` if they are known); no row is dropped."""
    return fill_zero(fill_mean(batch, mean, means), zero)


def fullest_row_per_hour(batch: DataFrame) -> DataFrame:
    """One row per airport and hour: the one with the fewest gaps, then the least by value."""
    readings = [name for name in batch.columns if name not in (CODE, TIME)]
    gaps = sum((F.col(name).isNull().cast("int") for name in readings), F.lit(0))
    return least_row_per_key(batch.withColumn("__gaps", gaps), [CODE, TIME], ["__gaps"]).drop("__gaps")


def unread_files(files: DataFrame, read: DataFrame | None, mark: Column | None, marks: DataFrame | None = None) -> DataFrame:
    """The files that can hold rows newer than the mark (or than ``marks``, one for each code).

    ``read`` has for each state of a file that was read (path, size, time of change) the latest time in it.  A file that was
    not read in its present state is unread; of the others only those with a later time than the mark are.
    """
    if read is None or mark is None and marks is None:
        return files
    latest = read.groupBy(*_VERSION).agg(F.max("latest").alias("latest"))
    known = match_unique(files, latest.withColumn("known", F.lit(True)), _VERSION, "left")
    if marks is not None:
        known = match_unique(known, marks.select(F.col(CODE).alias("code"), F.col("latest").alias("mark")), ["code"], "left")
        mark = F.col("mark")
    newer = F.col("latest").isNotNull() & F.coalesce(F.col("latest") > mark, F.lit(True))
    return known.filter(F.col("known").isNull() | newer).select(*files.columns)


def _content_hash(columns: Sequence[str]) -> Column:
    return F.md5(F.to_json(F.struct(*(F.col(name) for name in columns))).cast("binary"))


def _new_undated(spark: SparkSession, undated: DataFrame, opened: DataFrame, target: str) -> DataFrame:
    """Each distinct row of a file once, but for those that an earlier run has set aside.

    Only rows from files of this run are compared, by file and hash of their content: what other files gave, in however long
    a history, is not shuffled.
    """
    new = undated.dropDuplicates([FILE, _HASH])
    known = read_state(spark, target + UNDATED)
    if known is None:
        return new
    again = known.select(FILE, _HASH).join(opened.select(FILE), FILE, "left_semi")
    return new.join(again, [FILE, _HASH], "left_anti")


def _run(
    spark: SparkSession,
    target: str,
    state: DataFrame | None,
    files: DataFrame,
    layout: DatedCsv,
    backfill: DataFrame | None,
    numbers: Sequence[str],
    clean: Callable[..., DataFrame],
    per_airport: bool,
    dedupe: bool,
    drop_empty: bool,
    compact: bool,
    zone: str,
) -> dict[str, int]:
    nothing = {"written": 0, "unreadable_times": 0}
    target = target.rstrip("/")
    by_key = per_airport and state is not None
    mark = None if by_key else read_mark(state, TIME)
    marks = high_water_marks(state, TIME, [CODE]) if by_key else None
    with scratch_folder(spark, "weather") as work:
        opened = unread_files(files, read_state(spark, target + FILES), mark, marks)
        # The one listing of this run; what follows reads the list of the files to open.
        opened = materialize(opened, f"{work}/files")
        paths = paths_of(opened)
        scan = read_by_header(spark, files_by_header(spark, paths))
        tagged = None if scan is None else scan.withColumn(CODE, layout.code_of(FILE))
        present = [df for df in (backfill, tagged) if df is not None]
        if not present:
            return nothing
        text = union_all(present, allow_missing=True)
        if drop_empty:
            # Before the conversion: a condition over many converted columns costs the optimizer
            # time that doubles with each of them.
            text = drop_all_null(text, [CODE, FILE])
        readings = typed_readings(text.withColumn(_WRITTEN, F.col(TIME)), numbers, TIME, zone)
        dated = F.col(TIME).isNotNull()
        newer = dated if mark is None else dated & (F.col(TIME) > mark)
        # The text is parsed once; everything after reads the stored rows.  Counts and means are taken while they are written.
        seen = Observation()
        unplaced = [(~dated, "undated"), (~dated & F.col(_WRITTEN).isNotNull(), "unreadable")]
        facts = [*(F.count(F.when(rule, 1)).alias(name) for rule, name in unplaced), *_batch_facts(newer)]
        stored = materialize(readings.observe(seen, *facts), f"{work}/readings")
        found = first = seen.get
        batch = stored.filter(newer).drop(_WRITTEN, FILE)
        if by_key:
            batch = newer_than_per_key(batch, TIME, marks, [CODE])
        if dedupe:
            batch = fullest_row_per_hour(batch)
        if by_key or dedupe:
            seen = Observation()
            batch = materialize(batch.observe(seen, *_batch_facts(F.lit(True))), f"{work}/batch")
            found = seen.get
        run = StagedRun(spark, target)
        if found["written"]:
            means = {name: F.lit(found[f"mean_{name}"]).cast("double") for name in MEAN_FILLED}
            run.add(clean(batch, means=means), compact=compact)
        # Rows that cannot be placed in time are never compared with a mark: they go to a table of their own.
        if first["undated"]:
            undated = stored.filter(~dated).select(CODE, F.col(_WRITTEN).alias(TIME), *numbers, FILE)
            undated = undated.withColumn(_HASH, _content_hash([CODE, TIME, *numbers]))
            run.add(_new_undated(spark, undated, opened, target), UNDATED, compact=True)
        if paths:
            ends = stored.groupBy(FILE).agg(F.min(TIME).alias("earliest"), F.max(TIME).alias("latest"))
            run.add(match_unique(opened.select(*_VERSION, "code"), ends, [FILE], "left"), FILES, compact=True)
        run.publish()
    return {"written": found["written"], "unreadable_times": first["unreadable"]}


def _batch_facts(belongs: Column) -> list[Column]:
    """How many rows belong to the batch, and the means over them."""
    means = [F.avg(F.when(belongs, F.col(name))).alias(f"mean_{name}") for name in MEAN_FILLED]
    return [F.count(F.when(belongs, 1)).alias("written"), *means]


def _first_day(state: DataFrame | None, start: str, per_airport: bool, lateness_days: int | None) -> str:
    """The first day whose files can hold new rows, if files come at most so many days late."""
    if state is None or lateness_days is None:
        return start
    marks = high_water_marks(state, TIME, [CODE]).agg(F.min("latest")) if per_airport else state.agg(F.max(TIME))
    day = marks.select(F.date_sub(F.col(marks.columns[0]).cast("date"), lateness_days).cast("string")).first()[0]
    return max(start, day or start)


def _range(start: str, end: str | None) -> tuple[str, str]:
    return start, end or datetime.date.today().isoformat()


def run_forecast(
    spark: SparkSession,
    raw: str,
    target: str,
    airports: Sequence[str] = WEATHER_AIRPORTS,
    start: str = WEATHER_FIRST_DAY,
    end: str | None = None,
    layout: DatedCsv = FORECAST_FILES,
    per_airport: bool = False,
    dedupe: bool = False,
    lateness_days: int | None = None,
    zone: str = "UTC",
) -> dict[str, int]:
    """Append the forecast rows newer than the target's latest time; returns row counts.

    ``per_airport`` compares each airport with its own latest time instead of the latest of all.
    ``dedupe`` keeps one row per airport and hour of the batch.  Rows without a readable time go, as they are,
    to the table at ``target`` + ``-undated``.  Times with an offset are stored as the time in ``zone``.

    The table at ``target`` + ``-files`` has the earliest and latest time of each file read.  A file is opened if it was not
    read as it is now (by size and time of change), or if it holds a time later than the mark; so nothing late is lost, and
    files that were read are not opened again.  ``lateness_days`` bounds the listing too: it promises that files of a day
    hold nothing newer than the mark once the mark is so many days ahead of it.

    The three tables are written as one (see ``sinks.staged``): a run that breaks off leaves all or nothing.
    """
    finish_run(spark, target)
    state = read_state(spark, target)
    start = _first_day(state, start, per_airport, lateness_days)
    files = source_files(spark, raw, layout, airports, *_range(start, end))
    return _run(
        spark, target, state, files, layout, None, _FORECAST_NUMBERS, fill_forecast, per_airport, dedupe, drop_empty=True, compact=True, zone=zone
    )


def run_observed(
    spark: SparkSession,
    raw: str,
    target: str,
    airports: Sequence[str] = WEATHER_AIRPORTS,
    start: str = WEATHER_FIRST_DAY,
    end: str | None = None,
    layout: DatedCsv = OBSERVED_FILES,
    backfill: str | None = None,
    per_airport: bool = False,
    dedupe: bool = False,
    lateness_days: int | None = None,
    zone: str = "UTC",
) -> dict[str, int]:
    """As ``run_forecast`` for observed weather; the first run also takes the backfill files.

    The backfill lies in ``raw``/past unless another folder is given.
    """
    finish_run(spark, target)
    state = read_state(spark, target)
    start = _first_day(state, start, per_airport, lateness_days)
    files = source_files(spark, raw, layout, airports, *_range(start, end))
    history = None
    if state is None:
        history = read_backfill(spark, backfill or f"{raw.rstrip('/')}/past", airports, code_name=CODE)
    return _run(
        spark, target, state, files, layout, history, _OBSERVED_NUMBERS, clean_observed, per_airport, dedupe, drop_empty=False, compact=False, zone=zone
    )
