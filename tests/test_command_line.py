"""The jobs as started from the command line."""

from __future__ import annotations

import gzip
import json

import pytest
from tables import rows, write_text
from test_fares import HOUR, golden, put
from test_operations import ARRIVALS, DATE, DEPARTURES, write_day
from test_weather import FORECAST, reading
from test_weather import put as put_csv

from waymill import schemas
from waymill.__main__ import main


def test_fares(spark, tmp_path):
    put(tmp_path / "raw" / HOUR.removeprefix("raw/"), "a.json", golden())
    main(["fares", "--folder", str(tmp_path / "raw"), "--out", str(tmp_path / "out")])
    assert rows(spark.read.parquet(str(tmp_path / "out/parquet")), "url") == [("u2",), ("u4",)]
    write_text(tmp_path / "lines" / HOUR / "a.json", json.dumps(golden(), ensure_ascii=False))
    main(["fares", "--folder", str(tmp_path / "lines"), "--out", str(tmp_path / "out2"), "--lines", "--fare-type", "B01"])
    assert rows(spark.read.parquet(str(tmp_path / "out2/parquet")), "url") == [("u3",), ("u5",)]


def test_fares_of_compressed_files(spark, tmp_path):
    (tmp_path / HOUR).mkdir(parents=True)
    (tmp_path / HOUR / "a.json.gz").write_bytes(gzip.compress(json.dumps(golden(), ensure_ascii=False).encode()))
    main(["fares", "--folder", str(tmp_path), "--out", str(tmp_path / "out"), "--lines", "--files", "*.json.gz", "--csv-codec", "gzip"])
    assert spark.read.option("header", True).csv(str(tmp_path / "out/csv")).count() == 2 == len(rows(spark.read.parquet(str(tmp_path / "out/parquet"))))


def test_operations(spark, tmp_path, capsys):
    write_day(tmp_path / "raw", schemas.DEPARTURES_FILE, "D", "출발시간", DEPARTURES)
    write_day(tmp_path / "raw", schemas.ARRIVALS_FILE, "A", "도착시간", ARRIVALS)
    main(["operations", "--folder", str(tmp_path / "raw"), "--out", str(tmp_path / "out"), "--date", DATE])
    assert json.loads(capsys.readouterr().out) == {"departures": 1, "arrivals": 2, "total": 3}


def test_forecast(spark, tmp_path, capsys):
    put_csv(tmp_path / "raw", "2024/12/24/ICN_future_1.csv", FORECAST, reading("2024-12-24 00:00:00", 1.0))
    job = ["forecast", "--raw", str(tmp_path / "raw"), "--target", str(tmp_path / "target"), "--per-airport"]
    for written in (1, 0):
        main(job)
        assert json.loads(capsys.readouterr().out) == {"written": written, "unreadable_times": 0}


def test_unknown_job():
    with pytest.raises(SystemExit):
        main(["stream"])
