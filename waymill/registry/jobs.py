"""Whole jobs: inputs written from the given tables, the job run, its target read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..plans import profile_and_publish, run_daily_operations, run_forecast, run_observed
from ..sources import catalog_table
from ..storage import new_folder
from .incremental import PARTITIONED, range_and_codes, write_dated_csv
from .tables import Tables, collector

QUERIES, ORACLES, query = collector()

# What has come in before the first run.
_DAY = "2024-01-15"
_SHOWN = ("temperature_2m", "dew_point_2m", "precipitation", "wind_speed_10m")

# Readings made from events: some rows are empty, some have no readable time, and most columns have gaps.
_EMPTY = "event_type = 'purchase' AND user_id % 5 = 0"
_UNDATED = "event_type = 'signup' AND user_id % 7 = 0"
_READINGS = {
    "temperature_2m": "CASE WHEN event_type <> 'error' THEN value END",
    "relative_humidity_2m": "CASE WHEN user_id % 4 > 0 THEN value END",
    "dew_point_2m": "CASE WHEN user_id % 3 > 0 THEN value / 2 END",
    "precipitation": "CASE WHEN event_type <> 'view' THEN value END",
    "wind_speed_10m": "CASE WHEN user_id % 6 > 0 THEN value * 2 END",
    "visibility": "CASE WHEN event_type <> 'click' THEN cast(user_id % 4 AS double) END",
}


def _readings(t: Tables, columns: tuple[str, ...]) -> DataFrame:
    empty = F.expr(_EMPTY)
    time = F.when(F.expr(_UNDATED), "no time").otherwise(F.col("ts").cast("string"))
    values = [F.when(~empty, F.expr(_READINGS.get(name, "value"))).alias(name) for name in columns]
    return t.events.select(F.when(~empty, time).alias("timestamp"), *values, "ts", "event_type")


def _dated_csv(readings: DataFrame, folder: str) -> None:
    rows = readings.withColumnsRenamed({"ts": "__ts", "event_type": "__type"})
    names = [name for name in rows.columns if not name.startswith("__")]
    tagged = rows.select(*names, F.col("__ts").alias("day_of"), F.col("__type").alias("type_of"))
    write_dated_csv(tagged.withColumnRenamed("type_of", "of"), F.col("day_of"), F.col("of"), folder)


def _job_sql(time_columns: tuple[str, ...], mode: bool) -> str:
    values = ", ".join(f"{_READINGS[name]} AS {name}" for name in time_columns)
    means = "temperature_2m", "dew_point_2m"
    filled = [
        f"round(coalesce({name}, avg({name}) OVER (PARTITION BY batch)), 6) AS {name}"
        if name in means
        else f"coalesce({name}, 0.0) AS {name}"
        for name in _SHOWN
    ]
    first = "(SELECT max(ts) FROM r WHERE ts < TIMESTAMP '" + _DAY + "')"
    shown = ", ".join(filled) + (", coalesce(visibility, m.top) AS visibility" if mode else "")
    top = """
    , c AS (SELECT batch, visibility, count(*) AS n FROM b GROUP BY ALL),
    m AS (SELECT batch AS of, visibility AS top FROM c
          QUALIFY row_number() OVER (PARTITION BY batch ORDER BY n DESC, visibility ASC NULLS FIRST) = 1)
    """
    return f"""
    WITH r AS (SELECT ts, event_type AS airport_code, {values} FROM events WHERE NOT ({_EMPTY}) AND NOT ({_UNDATED})),
    b AS (SELECT *, ts > {first} AS batch FROM r) {top if mode else ""}
    SELECT airport_code, ts AS timestamp, {shown} FROM b {"JOIN m ON m.of = b.batch" if mode else ""}
    """


_FORECAST = (*_SHOWN, "visibility")


@query(_job_sql(_FORECAST, mode=True))
def forecast_job(t: Tables) -> DataFrame:
    """Two runs of the forecast job, the second over a folder that has all days; a third finds nothing."""
    columns = (*schemas.MEAN_FILLED, *schemas.FORECAST_ZERO_FILLED, *schemas.FORECAST_MODE_FILLED)
    readings = _readings(t, columns)
    first, last, codes = range_and_codes(t.events)
    raw, target = new_folder(t.spark, "forecast"), new_folder(t.spark, "future")
    _dated_csv(readings.filter(F.col("ts") < F.lit(_DAY).cast("timestamp_ntz")), f"{raw}-1")
    _dated_csv(readings, f"{raw}-2")
    for folder in (f"{raw}-1", f"{raw}-2", f"{raw}-2"):
        counts = run_forecast(t.spark, folder, target, codes, first, last, PARTITIONED)
    if counts["written"]:
        raise AssertionError("the third run has found new rows")
    means = {name: F.round(name, 6) for name in ("temperature_2m", "dew_point_2m")}
    return t.spark.read.parquet(target).withColumns(means).select("airport_code", "timestamp", *_FORECAST)


def _backfill(readings: DataFrame, folder: str) -> None:
    """One file per code, named as the one-time history is."""
    spark = readings.sparkSession
    rows = readings.drop("ts").withColumnRenamed("event_type", "code")
    rows.repartition("code").write.partitionBy("code").option("header", True).csv(f"{folder}/parts")
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = paths(f"{folder}/parts")
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(paths(f"{folder}/past"))
    for part in files.globStatus(paths(f"{folder}/parts/code=*/*.csv")):
        code = part.getPath().getParent().getName().split("=")[1]
        files.rename(part.getPath(), paths(f"{folder}/past/" + schemas.BACKFILL_GLOB.replace("{codes}", code)))


@query(_job_sql(_SHOWN, mode=False))
def observed_job(t: Tables) -> DataFrame:
    """The first run of the observed job takes the backfill, the second the days after it."""
    readings = _readings(t, (*schemas.MEAN_FILLED, *schemas.OBSERVED_ZERO_FILLED))
    # Here no row is dropped for being empty; such rows have no time.
    first, last, codes = range_and_codes(t.events)
    raw, target = new_folder(t.spark, "observed"), new_folder(t.spark, "past")
    early = F.col("ts") < F.lit(_DAY).cast("timestamp_ntz")
    _backfill(readings.filter(early), f"{raw}-history")
    _dated_csv(readings.filter(~early), raw)
    run_observed(t.spark, f"{raw}-none", target, codes, first, last, PARTITIONED, backfill=f"{raw}-history/past")
    run_observed(t.spark, raw, target, codes, first, last, PARTITIONED)
    means = {name: F.round(name, 6) for name in ("temperature_2m", "dew_point_2m")}
    return t.spark.read.parquet(target).withColumns(means).select("airport_code", "timestamp", *_SHOWN)


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, 2 * count(*) AS n_target, count(*) AS n_rows, count(*) - count({c}) AS n_null, "
        f"count(DISTINCT {c}) AS n_distinct, cast(min({c}) AS varchar) AS min_value, cast(max({c}) AS varchar) AS max_value FROM x"
        for c in ("o_orderkey", "o_orderstatus", "priority")
    ).join(
        [
            "WITH x AS (SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS priority FROM orders) ",
            "",
        ]
    )
)
def publish_job(t: Tables) -> DataFrame:
    """Profile and publish twice, the second time added to the first; the profile is read back from its output."""
    source, target = (f"waymill_{kind}_{uuid.uuid4().hex}" for kind in ("source", "target"))
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"))
    rows.write.option("path", new_folder(t.spark, "source")).saveAsTable(source)
    path, out = new_folder(t.spark, "published"), new_folder(t.spark, "profile")
    for _ in range(2):
        profile_and_publish(t.spark, source, target, path, profile_out=out)
    n = catalog_table(t.spark, target).count()
    for table in (source, target):
        t.spark.sql(f"DROP TABLE {table}")
    return t.spark.read.parquet(out).withColumn("n_target", F.lit(n).cast("long"))


def _recoded(column: str, names: dict[str, str], other: str) -> Column:
    return F.coalesce(*(F.when(F.col(column) == code, name) for code, name in names.items()), F.lit(other))


@query(
    """
    SELECT cast(o_orderkey AS varchar) AS flight_number, 'ICN' AS departure_airport_code,
           CASE o_custkey % 4 WHEN 0 THEN 'NRT' WHEN 1 THEN 'FUK' WHEN 2 THEN 'KIX' END AS arrival_airport_code,
           CASE o_orderstatus WHEN 'F' THEN '출발' ELSE '지연' END AS status, cast(o_orderdate AS varchar) AS actual_time
    FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_custkey % 4 < 3
    UNION ALL
    SELECT cast(l_orderkey AS varchar), CASE l_suppkey % 4 WHEN 0 THEN 'NRT' WHEN 1 THEN 'FUK' WHEN 2 THEN 'KIX' END, 'ICN',
           CASE l_returnflag WHEN 'A' THEN '도착' ELSE '취소' END, cast(l_shipdate AS varchar)
    FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_suppkey % 4 < 3
    """
)
def operations_files_job(t: Tables) -> DataFrame:
    """One day's files, found by their names, through the operations job; run twice, the day is replaced."""
    folder, out, date = new_folder(t.spark, "operations"), new_folder(t.spark, "day"), "20250113"
    airport = ["NRT", "FUK", "KIX", "LAX"]

    def code(column: str) -> Column:
        return F.get(F.array(*(F.lit(a) for a in airport)), (F.col(column) % 4).cast("int"))

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    category = F.lit(schemas.PASSENGER_CATEGORY).alias("구분")
    t.orders.select(
        text("o_orderkey").alias("편명"), F.lit("ICN").alias("출발공항코드"), code("o_custkey").alias("도착공항코드"), category,
        _recoded("o_orderstatus", {"F": "출발", "O": "지연"}, "도착").alias("현황"), text("o_orderdate").alias("실제시간"),
    ).write.parquet(f"{folder}/{schemas.DEPARTURES_FILE.format(date=date)}")
    t.lineitem.select(
        text("l_orderkey").alias("편명"), code("l_suppkey").alias("출발공항코드"), F.lit("ICN").alias("도착공항코드"), category,
        _recoded("l_returnflag", {"A": "도착", "R": "취소"}, "출발").alias("현황"), text("l_shipdate").alias("도착시간"),
    ).write.parquet(f"{folder}/{schemas.ARRIVALS_FILE.format(date=date)}")
    for _ in range(2):
        run_daily_operations(t.spark, folder, out, date)
    return t.spark.read.parquet(f"{out}/{date}").drop("category")
