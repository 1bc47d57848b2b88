"""High-water marks, first runs, missing inputs and dated CSV scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import high_water_mark, high_water_marks, newer_than, newer_than_per_key, read_mark
from ..sources import DatedCsv, read_dated_csv, read_state
from ..sources import missing_partitions as absent_inputs
from ..storage import new_folder
from .tables import Tables, collector

QUERIES, ORACLES, query = collector()

# The stored state: what had come in before this day.
_DAY = "2024-01-22"


def stored_events(t: Tables) -> DataFrame:
    return t.events.filter(F.col("ts") < F.lit(_DAY).cast("timestamp_ntz"))


@query(f"SELECT max(ts) AS latest FROM events WHERE ts < TIMESTAMP '{_DAY}'")
def latest_watermark(t: Tables) -> DataFrame:
    return high_water_mark(stored_events(t), "ts")


@query(
    f"""
    SELECT event_id, ts, value FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{_DAY}')
    """
)
def incremental_append(t: Tables) -> DataFrame:
    mark = read_mark(stored_events(t), "ts")
    return newer_than(t.events, "ts", mark).select("event_id", "ts", "value")


@query("SELECT event_id, ts, value FROM events")
def incremental_first_run(t: Tables) -> DataFrame:
    """The target does not exist: no mark, all rows."""
    state = read_state(t.spark, new_folder(t.spark, "no-target"))
    return newer_than(t.events, "ts", read_mark(state, "ts")).select("event_id", "ts", "value")


@query(
    f"""
    WITH w AS (SELECT user_id, event_type, max(ts) AS hi FROM events
               WHERE ts < TIMESTAMP '{_DAY}' AND event_type <> 'signup' GROUP BY ALL)
    SELECT e.event_id, e.user_id, e.event_type FROM events e LEFT JOIN w USING (user_id, event_type)
    WHERE w.hi IS NULL OR e.ts > w.hi
    """
)
def incremental_per_key(t: Tables) -> DataFrame:
    """A mark per user and type; keys without one keep all their rows."""
    keys = ["user_id", "event_type"]
    marks = high_water_marks(stored_events(t).filter(F.col("event_type") != "signup"), "ts", keys)
    return newer_than_per_key(t.events, "ts", marks, keys).select("event_id", *keys)


@query(
    """
    SELECT cast(cast(d AS date) AS varchar) AS day, t.event_type
    FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY) g(d)
    CROSS JOIN (SELECT DISTINCT event_type FROM events) t
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE cast(e.ts AS date) = cast(g.d AS date) AND e.event_type = t.event_type)
    """
)
def missing_partitions(t: Tables) -> DataFrame:
    found = t.events.select(F.col("ts").cast("date").alias("day"), "event_type")
    codes = t.events.select("event_type").dropDuplicates()
    absent = absent_inputs(codes, found, "2024-01-01", "2024-02-05", code="event_type")
    return absent.select(F.col("day").cast("string").alias("day"), "event_type")


# Spark names its partition folders column=value, so day and code are told from those.
PARTITIONED = DatedCsv("*.csv", day=r"/day=(\d{4})-(\d{2})-(\d{2})/", code=r"/code=([^/]+)/", folder="day=%Y-%m-%d")


def write_dated_csv(df: DataFrame, time: Column, code: Column, path: str, mode: str = "errorifexists") -> None:
    """One folder per day and code; large ones are split over several files."""
    tagged = df.withColumns({"day": time.cast("date"), "code": code})
    tagged.hint("rebalance", "day", "code").write.mode(mode).partitionBy("day", "code").option("header", True).csv(path)


def range_and_codes(events: DataFrame) -> tuple[str, str, list[str]]:
    """First day, last day and all codes of the events; a job is told codes, so these are few."""
    day = F.col("ts").cast("date")
    first, last, codes = events.agg(
        F.min(day).cast("string"), F.max(day).cast("string"), F.sort_array(F.collect_set("event_type"))
    ).first()
    return first, last, codes


@query(
    """
    SELECT event_id, value, event_type AS airport_code, cast(cast(ts AS date) AS varchar) AS day FROM events
    """
)
def daily_csv_scan(t: Tables) -> DataFrame:
    """All days and codes written as CSV files, read back by one scan with day and code from the path."""
    folder = new_folder(t.spark, "dated-csv")
    write_dated_csv(t.events.select("event_id", "value", "ts", "event_type"), F.col("ts"), F.col("event_type"), folder)
    first, last, codes = range_and_codes(t.events)
    scan = read_dated_csv(
        t.spark,
        folder,
        PARTITIONED,
        codes,
        first,
        last,
        columns=["event_id", "value", "ts", "event_type"],
        day_name="day",
    )
    return scan.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("value").cast("double").alias("value"),
        "airport_code",
        F.col("day").cast("string").alias("day"),
    )


_FAR = "CASE WHEN event_type = 'error' THEN upper(event_type) END"


@query(
    f"""
    SELECT event_id, value, CASE WHEN event_type <> 'signup' THEN user_id END AS user_id, {_FAR} AS further, event_type AS airport_code
    FROM events
    """
)
def csv_headers_apart(t: Tables) -> DataFrame:
    """CSV files in two orders of columns, some with a further column and some with one less, each read by its own header."""
    folder = new_folder(t.spark, "headers-apart")
    for kinds, columns in (
        (["view", "purchase"], ["event_id", "value", "user_id"]),
        (["click"], ["user_id", "value", "event_id"]),
        (["error"], ["event_id", "further", "user_id", "value"]),
        (["signup"], ["value", "event_id"]),
    ):
        rows = t.events.filter(F.col("event_type").isin(kinds)).withColumn("further", F.upper("event_type"))
        write_dated_csv(rows.select(*columns, "ts", "event_type"), F.col("ts"), F.col("event_type"), folder, "append")
    first, last, codes = range_and_codes(t.events)
    scan = read_dated_csv(t.spark, folder, PARTITIONED, codes, first, last)
    numbers = {"event_id": "bigint", "value": "double", "user_id": "bigint"}
    return scan.select(*(F.col(c).cast(kind).alias(c) for c, kind in numbers.items()), "further", "airport_code")
