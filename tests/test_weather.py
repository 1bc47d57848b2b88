"""The weather jobs on dated CSV files."""

from __future__ import annotations

import datetime
import shutil

import pytest
from tables import rows, write_text

from waymill.operators import fill_mean, fill_mode, fill_zero, most_frequent, typed_readings
from waymill.plans import run_forecast, run_observed, weather
from waymill.schemas import FORECAST_MODE_FILLED, FORECAST_ZERO_FILLED, MEAN_FILLED, OBSERVED_ZERO_FILLED
from waymill.sinks import StagedRun, staged
from waymill.sources import (
    FORECAST_FILES,
    day_folders,
    expected_inputs,
    inline_table,
    list_inputs,
    missing_partitions,
    read_dated_csv,
    source_files,
)

FORECAST = ["timestamp", *MEAN_FILLED, *FORECAST_ZERO_FILLED, *FORECAST_MODE_FILLED]
OBSERVED = ["timestamp", *MEAN_FILLED, *OBSERVED_ZERO_FILLED, "note"]


def put(raw, path, columns, *records):
    lines = [",".join(columns)]
    lines += [",".join(str(record.get(name, "")) for name in columns) for record in records]
    write_text(raw / path, *lines)


def reading(time, temperature="", precipitation="", visibility="", **more):
    return {"timestamp": time, "temperature_2m": temperature, "precipitation": precipitation, "visibility": visibility, **more}


def at(text):
    return datetime.datetime.fromisoformat(text)


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    day = "2024/12/24"
    put(folder, f"{day}/ICN_future_1.csv", FORECAST,
        reading("2024-12-24 00:00:00", 1.0, 0.2, 10000), reading("2024-12-24 01:00:00", visibility=10000))
    put(folder, f"{day}/NRT_future_1.csv", FORECAST, reading("2024-12-24 00:00:00", 3.0), reading("2024-12-24 01:00:00"))
    put(folder, f"{day}/FUK_future_1.csv", FORECAST, reading("2024-12-24 00:00:00", 5.0, 0.4, 10000), reading(""))
    return folder


def forecast(spark, raw, tmp_path, end="2024-12-31", **options):
    return run_forecast(spark, str(raw), str(tmp_path / "target"), end=end, **options)


def stored(spark, tmp_path, *columns):
    return rows(spark.read.parquet(str(tmp_path / "target")), *columns)


def data_files(path):
    return len(list(path.glob("part-*.parquet")))


def test_first_forecast_run(spark, raw, tmp_path):
    assert forecast(spark, raw, tmp_path) == {"written": 5, "unreadable_times": 0}
    zero, one = at("2024-12-24T00:00:00"), at("2024-12-24T01:00:00")
    assert stored(spark, tmp_path, "airport_code", "timestamp", "temperature_2m", "precipitation", "visibility") == [
        ("FUK", zero, 5.0, 0.4, 10000.0),
        ("ICN", zero, 1.0, 0.2, 10000.0),
        ("ICN", one, 3.0, 0.0, 10000.0),
        ("NRT", zero, 3.0, 0.0, 10000.0),
        ("NRT", one, 3.0, 0.0, 10000.0),
    ]
    # a mean over nothing is null
    assert stored(spark, tmp_path, "relative_humidity_2m") == [(None,)] * 5
    assert data_files(tmp_path / "target") == 1


@pytest.mark.parametrize("per_airport, added", [(False, [("ICN", 7.0)]), (True, [("FUK", 9.0), ("ICN", 7.0)])])
def test_second_forecast_run(spark, raw, tmp_path, per_airport, added):
    forecast(spark, raw, tmp_path)
    before = stored(spark, tmp_path, "airport_code", "temperature_2m")
    put(raw, "2024/12/25/ICN_future_2.csv", FORECAST, reading("2024-12-25 00:00:00", 7.0))
    put(raw, "2024/12/25/FUK_future_2.csv", FORECAST, reading("2024-12-24 01:00:00", 9.0))
    assert forecast(spark, raw, tmp_path, per_airport=per_airport)["written"] == len(added)
    assert stored(spark, tmp_path, "airport_code", "temperature_2m") == sorted(before + added, key=repr)
    # nothing is newer than the mark now
    assert forecast(spark, raw, tmp_path, per_airport=per_airport)["written"] == 0
    assert data_files(tmp_path / "target") == 2


def test_days_outside_the_range_are_not_opened(spark, raw, tmp_path):
    put(raw, "2024/12/20/CTS_future_9.csv", ["other", "header"])
    put(raw, "2024/12/30/ICN_future_9.csv", ["other", "header"])
    put(raw, "2024/12/24/LAX_future_9.csv", ["other", "header"])
    put(raw, "2024/12/24/ICN_past_9.csv", ["other", "header"])
    assert forecast(spark, raw, tmp_path, end="2024-12-29")["written"] == 5


def test_each_file_is_read_by_its_own_header(spark, raw, tmp_path):
    swapped = [FORECAST[2], FORECAST[1], FORECAST[0], *FORECAST[3:-1]]
    put(raw, "2024/12/26/ICN_future_3.csv", swapped, reading("2024-12-26 00:00:00", 7.0))
    put(raw, "2024/12/26/NRT_future_3.csv", [*FORECAST, "further"], reading("2024-12-26 00:00:00", 8.0, visibility=5, further="x"))
    assert forecast(spark, raw, tmp_path)["written"] == 7
    target = spark.read.parquet(str(tmp_path / "target"))
    assert rows(target.filter("timestamp >= '2024-12-26'"), "airport_code", "temperature_2m", "visibility", "further") == [
        ("ICN", 7.0, None, None),  # three nulls and three times 10000: nothing is filled
        ("NRT", 8.0, 5.0, "x"),
    ]


def test_absent_column_fails_with_its_name(spark, tmp_path):
    put(tmp_path / "raw", "2024/12/24/ICN_future_1.csv", FORECAST[:-1], reading("2024-12-24 00:00:00"))
    with pytest.raises(ValueError, match="visibility"):
        forecast(spark, tmp_path / "raw", tmp_path)


def test_unreadable_times_are_counted(spark, raw, tmp_path):
    put(raw, "2024/12/25/ICN_future_2.csv", FORECAST, reading("no time", 7.0))
    assert forecast(spark, raw, tmp_path) == {"written": 5, "unreadable_times": 1}
    undated = spark.read.parquet(str(tmp_path / "target-undated"))
    assert rows(undated, "airport_code", "timestamp", "temperature_2m") == [("ICN", "no time", 7.0)]


def test_only_empty_rows_write_nothing(spark, tmp_path):
    put(tmp_path / "raw", "2024/12/24/ICN_future_1.csv", FORECAST, reading(""), reading(""))
    put(tmp_path / "raw", "2024/12/24/NRT_future_1.csv", FORECAST)
    assert forecast(spark, tmp_path / "raw", tmp_path) == {"written": 0, "unreadable_times": 0}
    assert not (tmp_path / "target").exists()


def test_no_input_at_all(spark, tmp_path):
    assert forecast(spark, tmp_path / "nowhere", tmp_path)["written"] == 0
    assert not (tmp_path / "target").exists()


@pytest.mark.parametrize("dedupe, written", [(False, 7), (True, 6)])
def test_observed_first_run_takes_the_backfill(spark, tmp_path, dedupe, written):
    raw = tmp_path / "raw"
    for code in ("ICN", "NRT", "FUK", "KIX", "CTS"):
        put(raw, f"past/{code}_20240101_20241228.csv", OBSERVED, {"timestamp": "2024-12-28 00:00:00", "temperature_2m": 2, "note": code})
    put(raw, "2024/12/28/ICN_past_1.csv", OBSERVED, {"timestamp": "2024-12-28 00:00:00", "rain": 1}, {"timestamp": "2024-12-28 01:00:00", "temperature_2m": 8})
    result = run_observed(spark, str(raw), str(tmp_path / "target"), end="2024-12-31", dedupe=dedupe)
    assert result["written"] == written
    target = spark.read.parquet(str(tmp_path / "target"))
    assert {"note", "airport_code", "wind_gusts_10m"} <= set(target.columns)
    mean = 3.0  # of 2 (five times) and 8
    icn = [(at("2024-12-28T00:00:00"), 2.0, 0.0), (at("2024-12-28T01:00:00"), 8.0, 0.0)]
    if not dedupe:  # of the two rows for midnight, the one with fewer gaps is the one to stay
        icn.append((at("2024-12-28T00:00:00"), mean, 1.0))
    assert rows(target.filter("airport_code = 'ICN'"), "timestamp", "temperature_2m", "rain") == sorted(icn, key=repr)
    # a later run has a mark and does not read the backfill again
    assert run_observed(spark, str(raw), str(tmp_path / "target"), end="2024-12-31")["written"] == 0


def test_observed_backfill_must_be_complete(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw, "past/ICN_20240101_20241228.csv", OBSERVED)
    with pytest.raises(FileNotFoundError, match="NRT, FUK, KIX, CTS"):
        run_observed(spark, str(raw), str(tmp_path / "target"), end="2024-12-31")


def test_corrupt_target_is_no_first_run(spark, raw, tmp_path):
    write_text(tmp_path / "target/part-0.parquet", "this is no Parquet file")
    with pytest.raises(Exception, match="(?i)parquet"):
        forecast(spark, raw, tmp_path)


def test_missing_inputs(spark, raw):
    codes = inline_table(spark, [("ICN",), ("NRT",), ("KIX",)], "code STRING")
    found = list_inputs(spark, str(raw), FORECAST_FILES, ["ICN", "NRT", "KIX"], "2024-12-24", "2024-12-25")
    missing = missing_partitions(codes, found, "2024-12-24", "2024-12-25")
    day, next_day = datetime.date(2024, 12, 24), datetime.date(2024, 12, 25)
    assert rows(missing, "code", "day") == [("ICN", next_day), ("KIX", day), ("KIX", next_day), ("NRT", next_day)]
    assert expected_inputs(codes, "2024-12-24", "2025-01-02").count() == 30
    assert list_inputs(spark, str(raw) + "/none", FORECAST_FILES, ["ICN"], "2024-12-24", "2024-12-25").count() == 0


def test_one_scan_tags_code_and_day(spark, raw):
    scan = read_dated_csv(spark, str(raw), FORECAST_FILES, ["ICN", "FUK"], "2024-12-24", "2024-12-24", day_name="day")
    assert scan.columns == [*FORECAST, "airport_code", "day"]
    assert rows(scan.groupBy("airport_code", "day").count()) == [
        ("FUK", datetime.date(2024, 12, 24), 2),
        ("ICN", datetime.date(2024, 12, 24), 2),
    ]


def test_zero_mean_fills_and_nan_does_not_spoil_it(spark):
    text = spark.createDataFrame([("-1",), ("1",), ("NaN",), ("abc",), (None,)], "x STRING")
    assert rows(fill_mean(typed_readings(text, ["x"]), ["x"])) == [(-1.0,), (0.0,), (0.0,), (0.0,), (1.0,)]
    assert rows(fill_zero(typed_readings(text, ["x"]), ["x"])) == [(-1.0,), (0.0,), (0.0,), (0.0,), (1.0,)]


def test_mode_counts_nulls_unless_ignored(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",), ("b",), (None,)], "x STRING")
    assert rows(fill_mode(df, ["x"])) == rows(df)
    assert rows(fill_mode(df, ["x"], ignore_nulls=True)) == [("a",)] + [("b",)] * 5
    assert rows(most_frequent(df, "x")) == [(None, 3)]
    tie = spark.createDataFrame([("b",), ("a",), (None,)], "x STRING")
    assert rows(most_frequent(tie, "x", ignore_nulls=True)) == [("a", 1)]
    assert fill_mode(df.limit(0), ["x"]).count() == 0


def opened(spark, tmp_path):
    """Names of the files that the last run has recorded."""
    files = spark.read.parquet(str(tmp_path / "target-files"))
    return sorted(r["source_file"].rsplit("/", 1)[1] for r in files.collect())


def test_files_without_newer_rows_stay_closed(spark, raw, tmp_path, monkeypatch):
    seen = []
    read = weather.files_by_header

    def watched(spark, paths):
        seen.append(sorted(path.rsplit("/", 1)[1] for path in paths.values()))
        return read(spark, paths)

    monkeypatch.setattr(weather, "files_by_header", watched)
    assert forecast(spark, raw, tmp_path)["written"] == 5
    assert opened(spark, tmp_path) == ["FUK_future_1.csv", "ICN_future_1.csv", "NRT_future_1.csv"]
    assert forecast(spark, raw, tmp_path)["written"] == 0
    # A late file for an old day, one that has changed, and one that gives nothing.
    put(raw, "2024/12/24/CTS_future_7.csv", FORECAST, reading("2024-12-24 07:00:00", 4.0), reading("later", 1.0))
    put(raw, "2024/12/24/NRT_future_1.csv", FORECAST, reading("2024-12-24 01:00:00", 9.0), reading("2024-12-24 09:00:00", 9.0))
    put(raw, "2024/12/25/KIX_future_1.csv", FORECAST)
    assert forecast(spark, raw, tmp_path) == {"written": 2, "unreadable_times": 1}
    assert forecast(spark, raw, tmp_path) == {"written": 0, "unreadable_times": 0}
    first = ["FUK_future_1.csv", "ICN_future_1.csv", "NRT_future_1.csv"]
    assert seen == [first, [], ["CTS_future_7.csv", "KIX_future_1.csv", "NRT_future_1.csv"], []]
    # Without its rows a target is filled from all files again; what is set aside is not repeated.
    shutil.rmtree(tmp_path / "target")
    assert forecast(spark, raw, tmp_path)["written"] == 6
    assert rows(spark.read.parquet(str(tmp_path / "target-undated")), "airport_code", "timestamp") == [("CTS", "later")]


def test_marks_per_airport_open_only_their_files(spark, raw, tmp_path):
    forecast(spark, raw, tmp_path)
    stored_files = spark.read.parquet(str(tmp_path / "target-files"))
    listed = source_files(spark, str(raw), FORECAST_FILES, ["ICN", "NRT", "FUK"], "2024-12-24", "2024-12-24")
    marks = spark.createDataFrame([("ICN", at("2024-12-24T00:30:00")), ("NRT", at("2024-12-24T01:00:00"))], "airport_code string, latest timestamp_ntz")
    found = rows(weather.unread_files(listed, stored_files, None, marks), "code")
    assert found == [("FUK",), ("ICN",)]


@pytest.mark.parametrize("broken", ["-undated", "-files"])
def test_a_run_that_breaks_off_leaves_nothing(spark, raw, tmp_path, monkeypatch, broken):
    put(raw, "2024/12/25/ICN_future_2.csv", FORECAST, reading("no time", 7.0))
    add = StagedRun.add

    def failing(self, df, table="", compact=False):
        if table == broken:
            raise OSError("disk is gone")
        add(self, df, table, compact)

    monkeypatch.setattr(StagedRun, "add", failing)
    with pytest.raises(OSError):
        forecast(spark, raw, tmp_path)
    assert not (tmp_path / "target").exists() and (tmp_path / "target-staged").exists()
    monkeypatch.setattr(StagedRun, "add", add)
    assert forecast(spark, raw, tmp_path) == {"written": 5, "unreadable_times": 1}
    assert len(stored(spark, tmp_path, "timestamp")) == 5 and spark.read.parquet(str(tmp_path / "target-undated")).count() == 1
    assert not (tmp_path / "target-staged").exists()


def test_a_published_run_is_carried_through(spark, raw, tmp_path, monkeypatch):
    move, moved = staged._move, []

    def failing(spark, files, source, target):
        if moved:
            raise OSError("driver is gone")
        moved.append(target)
        move(spark, files, source, target)

    monkeypatch.setattr(staged, "_move", failing)
    with pytest.raises(OSError):
        forecast(spark, raw, tmp_path)
    monkeypatch.setattr(staged, "_move", move)
    # The next run finds everything of the one before, and so nothing new.
    assert forecast(spark, raw, tmp_path) == {"written": 0, "unreadable_times": 0}
    assert len(stored(spark, tmp_path, "timestamp")) == 5
    assert opened(spark, tmp_path) == ["FUK_future_1.csv", "ICN_future_1.csv", "NRT_future_1.csv"]
    assert not (tmp_path / "target-staged").exists()


def test_only_folders_of_the_range_are_listed(spark, tmp_path):
    for year in range(2000, 2024):
        put(tmp_path / "raw", f"{year}/12/24/ICN_future_1.csv", FORECAST)
    for day in range(1, 32):
        put(tmp_path / "raw", f"2024/12/{day:02}/ICN_future_1.csv", FORECAST)
    folders = day_folders(spark, str(tmp_path / "raw"), FORECAST_FILES, "2024-12-20", "2025-02-10")
    assert len(folders) == 12
    files = source_files(spark, str(tmp_path / "raw"), FORECAST_FILES, ["ICN"], "2024-12-20", "2025-02-10")
    location = files._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    assert location.rootPaths().size() == 12 and files.count() == 12
    assert day_folders(spark, str(tmp_path / "none"), FORECAST_FILES, "2024-12-20", "2026-02-10") == []


def test_headers_apart(spark, tmp_path):
    root = tmp_path / "r [1] {a}"
    put(root, "2024/12/24/ICN_future_1.csv", ["a", "b"], {"a": 1, "b": 2})
    put(root, "2024/12/24/NRT_future_1.csv", ["b", "a"], {"a": 3, "b": 4})
    write_text(root / "2024/12/24/FUK_future_1.csv", "", '"a","c d"', "5,6")
    write_text(root / "2024/12/24/KIX_future_1.csv")
    raw = str(tmp_path) + r"/r \[1\] \{a\}"
    scan = read_dated_csv(spark, raw, FORECAST_FILES, ["ICN", "NRT", "FUK", "KIX"], "2024-12-24", "2024-12-24")
    assert rows(scan, "a", "b", "c d", "airport_code") == [("1", "2", None, "ICN"), ("3", "4", None, "NRT"), ("5", None, "6", "FUK")]
    put(root, "2024/12/25/ICN_future_1.csv", ["a", "A"], {"a": 1})
    with pytest.raises(ValueError, match="twice"):
        read_dated_csv(spark, raw, FORECAST_FILES, ["ICN"], "2024-12-25", "2024-12-25")
