"""The jobs from the command line, e.g. under spark-submit: ``python -m waymill fares --folder … --out …``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .plans import profile_and_publish, run_daily_operations, run_fares, run_forecast, run_observed
from .schemas import WEATHER_AIRPORTS, WEATHER_FIRST_DAY
from .session import SETTINGS


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="waymill", description="Batch jobs for travel data")
    jobs = parser.add_subparsers(dest="job", required=True)

    fares = jobs.add_parser("fares", help="fare-search documents to the cheapest offer per itinerary")
    fares.add_argument("--folder", required=True, help="one extraction, or a folder of many")
    fares.add_argument("--out", required=True)
    fares.add_argument("--fare-type", default="A01")
    fares.add_argument("--passenger", default="Adult", choices=("Adult", "Child", "Infant"))
    fares.add_argument("--append", action="store_true", help="add to the output instead of replacing it")
    fares.add_argument("--lines", action="store_true", help="files hold one document per line")
    fares.add_argument("--files", default="*.json", help="names of the documents' files, e.g. *.json.gz for compressed ones")
    fares.add_argument("--csv-codec", help="compress the CSV files, e.g. by gzip")

    operations = jobs.add_parser("operations", help="one day's departures and arrivals of the target airports")
    operations.add_argument("--folder", required=True)
    operations.add_argument("--out", required=True)
    operations.add_argument("--date", required=True)

    for name in ("forecast", "observed"):
        weather = jobs.add_parser(name, help=f"append new {name} weather to the target")
        weather.add_argument("--raw", required=True)
        weather.add_argument("--target", required=True)
        weather.add_argument("--airports", nargs="+", default=WEATHER_AIRPORTS)
        weather.add_argument("--start", default=WEATHER_FIRST_DAY, help="first day, yyyy-MM-dd")
        weather.add_argument("--end", help="last day, today by default")
        weather.add_argument("--per-airport", action="store_true", help="one high-water mark per airport")
        weather.add_argument("--dedupe", action="store_true", help="one row per airport and hour of the batch")
        weather.add_argument("--lateness-days", type=int, help="do not open files older than the mark by more days")
        weather.add_argument("--zone", default="UTC", help="zone of the stored times, for times with an offset")

    publish = jobs.add_parser("publish", help="profile a catalog table and write it to another")
    publish.add_argument("--source", required=True)
    publish.add_argument("--target", required=True)
    publish.add_argument("--path")
    publish.add_argument("--mode", default="append", choices=("append", "overwrite"))
    publish.add_argument("--approximate", action="store_true", help="estimate distinct counts")
    publish.add_argument("--profile-out", help="Parquet folder for the profile")
    return parser


def main(arguments: Sequence[str] | None = None) -> None:
    options = vars(_arguments().parse_args(arguments))
    job = options.pop("job")
    builder = SparkSession.builder.appName(f"waymill {job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if job == "fares":
        run_fares(spark, one_per_file=not options.pop("lines"), **options)
    elif job == "publish":
        print(json.dumps([row.asDict() for row in profile_and_publish(spark, **options).collect()], ensure_ascii=False))
    else:
        run = {"operations": run_daily_operations, "forecast": run_forecast, "observed": run_observed}[job]
        print(json.dumps(run(spark, **options)))


if __name__ == "__main__":
    main()
