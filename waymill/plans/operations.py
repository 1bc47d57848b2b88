"""Daily flight operations: departures and arrivals of the target airports in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import keep_targets, rename_columns, union_all
from ..sinks import overwrite_parquet
from ..sources import inline_table, read_daily


def target_airports(spark: SparkSession) -> DataFrame:
    return inline_table(spark, schemas.TARGET_AIRPORTS, schemas.TARGET_AIRPORTS_SCHEMA)


def _direction(
    df: DataFrame, targets: DataFrame, names: dict[str, str], code: str, statuses: tuple[str, ...]
) -> DataFrame:
    of_passengers = F.col("category") == schemas.PASSENGER_CATEGORY
    return keep_targets(
        rename_columns(df, names),
        targets,
        code,
        "airport_code",
        where=F.col("status").isin(*statuses) & of_passengers,
    )


def daily_operations(
    departures: DataFrame,
    arrivals: DataFrame,
    targets: DataFrame,
    counts: tuple[Observation, Observation] | None = None,
) -> DataFrame:
    """Passenger flights to the targets (departures) and from them (arrivals), in the source's row shape."""
    branches = [
        _direction(departures, targets, schemas.DEPARTURE_NAMES, "arrival_airport_code", schemas.DEPARTURE_STATUSES),
        _direction(arrivals, targets, schemas.ARRIVAL_NAMES, "departure_airport_code", schemas.ARRIVAL_STATUSES),
    ]
    if counts:
        branches = [branch.observe(count, F.count("*").alias("n")) for branch, count in zip(branches, counts)]
    return union_all(branches)


def run_daily_operations(
    spark: SparkSession, folder: str, out: str, date: str, targets: DataFrame | None = None
) -> dict[str, int]:
    """Process one day into ``out``/``date``, replacing what is there; returns the row counts.

    The counts are taken while the rows are written, so each input is read once.
    """
    counts = Observation("departures"), Observation("arrivals")
    flights = daily_operations(
        read_daily(spark, folder, schemas.DEPARTURES_FILE, date),
        read_daily(spark, folder, schemas.ARRIVALS_FILE, date),
        target_airports(spark) if targets is None else targets,
        counts,
    )
    overwrite_parquet(flights, f"{out.rstrip('/')}/{date}")
    departures, arrivals = (count.get["n"] for count in counts)
    return {"departures": departures, "arrivals": arrivals, "total": departures + arrivals}
