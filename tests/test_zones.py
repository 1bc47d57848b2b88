"""Marks and times must not depend on the zone of the driver's machine."""

from __future__ import annotations

import datetime
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from waymill.operators import newer_than, read_mark, typed_readings

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
from waymill.registry import QUERIES
from waymill.session import local_session
spark = local_session(2, 4, "2g")
spark.sparkContext.setLogLevel("ERROR")
for name in ("incremental_append", "weather_batch_clean", "observed_batch_clean", "empty_batch_guard", "forecast_job"):
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def counts(zone: str) -> str:
    environment = os.environ | {"TZ": zone, "PYTHONPATH": str(ROOT)}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=environment, capture_output=True, text=True, timeout=300, check=True)
    return done.stdout


def test_results_are_the_same_in_every_zone():
    expected = counts("UTC")
    assert len(expected.splitlines()) == 5
    for zone in ("Asia/Seoul", "America/New_York"):
        assert counts(zone) == expected


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "decimal(20,3)", "bigint"])
def test_marks_are_exact_in_every_type(spark, kind):
    value = {"double": "0.1", "decimal(20,3)": "12345678901234567.891", "bigint": "7"}.get(kind, "2024-11-03 01:30:00.123456")
    df = spark.range(1).select(F.lit(value).cast(kind).alias("t"))
    mark = read_mark(df, "t")
    assert newer_than(df, "t", mark).isEmpty()
    assert df.filter(F.col("t") >= mark).count() == 1
    assert read_mark(df.limit(0), "t") is None


def test_times_with_offsets(spark):
    texts = {
        "2024-12-24 00:00:00+09:00": "2024-12-23T15:00:00",
        "2024-12-24T00:00-0500": "2024-12-24T05:00:00",
        "2024-01-01T00:00Z": "2024-01-01T00:00:00",
        "2024-12-24 00:00:00.5 +00:30": "2024-12-23T23:30:00.500000",
        "2024-12-24 00:00:00": "2024-12-24T00:00:00",
        "2024-12-24": "2024-12-24T00:00:00",
        "never": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "time STRING").withColumn("text", F.col("time"))
    found = {r["text"]: r["time"] for r in typed_readings(df, [], "time").collect()}
    assert found == {t: e and datetime.datetime.fromisoformat(e) for t, e in texts.items()}
    seoul = {r["text"]: r["time"] for r in typed_readings(df, [], "time", zone="Asia/Seoul").collect()}
    assert seoul["2024-12-24 00:00:00+09:00"] == seoul["2024-12-24 00:00:00"] == datetime.datetime(2024, 12, 24)
