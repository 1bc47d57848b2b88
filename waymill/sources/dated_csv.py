"""CSV files in dated folders, one set of files per code (airport) and day."""

from __future__ import annotations

import csv
import datetime
import posixpath
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BACKFILL_GLOB
from ..storage import file_system
from .absence import if_present

# The column that tells a row's file, as Spark's scans name it.
FILE = "source_file"
# Days whose folders are looked up by one pattern.
_DAYS = 366
_INVENTORY = f"path STRING, {FILE} STRING, size BIGINT, modified BIGINT, day STRING, code STRING"


@dataclass(frozen=True)
class DatedCsv:
    """How day and code are told from a file's path.

    ``day`` must match year, month and day as three groups, ``code`` the code as one.
    In ``glob``, ``{codes}`` stands for the requested codes.  ``folder`` names a day's folder below the root, in the letters of
    ``strftime``.
    """

    glob: str
    day: str = r"/(\d{4})/(\d{2})/(\d{2})/[^/]*$"
    code: str = r"/([^/_]+)_[^/]*$"
    folder: str = "%Y/%m/%d"

    def name_filter(self, codes: Sequence[str]) -> str:
        return self.glob.replace("{codes}", "{" + ",".join(codes) + "}")

    def day_of(self, path: Column | str) -> Column:
        """The day as ``yyyy-MM-dd`` text, ``--`` if the path has none."""
        return F.concat_ws("-", *(F.regexp_extract(path, self.day, group) for group in (1, 2, 3)))

    def code_of(self, path: Column | str) -> Column:
        return F.regexp_extract(path, self.code, 1)

    def wanted(self, path: Column | str, codes: Sequence[str], start: str, end: str) -> Column:
        return self.day_of(path).between(start, end) & self.code_of(path).isin(*codes)

    def folders(self, start: str, end: str) -> Iterator[list[str]]:
        """The names of the days' folders (``yyyy-MM-dd``, both ends included), some at a time."""
        first, last = datetime.date.fromisoformat(start), datetime.date.fromisoformat(end)
        days = [first + datetime.timedelta(i) for i in range((last - first).days + 1)]
        for i in range(0, len(days), _DAYS):
            yield list(dict.fromkeys(day.strftime(self.folder) for day in days[i : i + _DAYS]))


FORECAST_FILES = DatedCsv("{codes}_future_*.csv")
OBSERVED_FILES = DatedCsv("{codes}_past_*.csv")


def day_folders(spark: SparkSession, folder: str, layout: DatedCsv, start: str, end: str) -> list[str]:
    """The days' folders that exist: their names come from the range, and nothing else below ``folder`` is looked at."""
    found = []
    for names in layout.folders(start, end):
        files, pattern = file_system(spark, f"{folder.rstrip('/')}/{{{','.join(names)}}}")
        found += [status.getPath().toString() for status in files.globStatus(pattern) or [] if status.isDirectory()]
    return found


def source_files(
    spark: SparkSession, folder: str, layout: DatedCsv, codes: Sequence[str], start: str, end: str
) -> DataFrame:
    """Path, size, time of change (microseconds), day and code of every file of the range, without opening any.

    The days' folders are listed by tasks where there are many of them.  The table is lazy, but the listing is
    made here, once; what reads the table several times lists nothing again.
    """
    folders = day_folders(spark, folder, layout, start, end)
    if not folders:
        return spark.createDataFrame([], _INVENTORY)
    # This source reads a file's content only when that column is asked for.
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.option("pathGlobFilter", layout.name_filter(codes)).load([_literal(name) for name in folders])
    return files.filter(layout.wanted("path", codes, start, end)).select(
        "path",
        F.col("_metadata.file_path").alias(FILE),
        F.col("length").alias("size"),
        F.unix_micros("modificationTime").alias("modified"),
        layout.day_of("path").alias("day"),
        layout.code_of("path").alias("code"),
    )


def _literal(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def paths_of(files: DataFrame) -> dict[str, str]:
    """File names, as scans give them, and their paths (of ``source_files``): the driver needs these for the scans."""
    return {row[FILE]: row["path"] for row in files.select(FILE, "path").collect()}


def files_by_header(spark: SparkSession, paths: Mapping[str, str]) -> dict[tuple[str, ...], list[str]]:
    """The paths of files (``paths_of``) by the column names in their first line.

    Tasks look at the lines and keep the first of each file; only the different headers, with their files' names, come to the
    driver.  A file without any line is left out.
    """
    if not paths:
        return {}
    lines = spark.read.text([_literal(path) for path in paths.values()]).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    lines = lines.withColumn("line", F.monotonically_increasing_id()).filter("block = 0 AND length(trim(value)) > 0")
    firsts = lines.groupBy(FILE).agg(F.min_by("value", "line").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    groups = firsts.groupBy("header").agg(F.collect_list(FILE).alias("files")).collect()
    for header, files in sorted((row["header"], sorted(row["files"])) for row in groups):
        names = tuple(name or f"_c{i}" for i, name in enumerate(next(csv.reader([header]))))
        if len({name.lower() for name in names}) < len(names):
            raise ValueError(f"{files[0]}: a column name stands twice in the header")
        found.setdefault(names, []).extend(paths[file] for file in files)
    return found


def read_by_header(spark: SparkSession, groups: Mapping[tuple[str, ...], Sequence[str]]) -> DataFrame | None:
    """All files as text columns and their file's name: one scan for each header, united by name, with nulls for absent columns."""
    scans = []
    for names, paths in groups.items():
        schema = ", ".join(f"`{name.replace('`', '``')}` STRING" for name in names)
        # The header of each file is checked once more when it is read.
        reader = spark.read.option("header", True).option("enforceSchema", False).schema(schema)
        columns = [F.col(f"`{name.replace('`', '``')}`") for name in names]
        scans.append(reader.csv([_literal(p) for p in paths]).select(*columns, F.col("_metadata.file_path").alias(FILE)))
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), scans) if scans else None


def read_dated_csv(
    spark: SparkSession,
    folder: str,
    layout: DatedCsv,
    codes: Sequence[str],
    start: str,
    end: str,
    columns: Sequence[str] | None = None,
    code_name: str = "airport_code",
    day_name: str | None = None,
) -> DataFrame | None:
    """Files of the given codes and days (``yyyy-MM-dd``, both ends included), tagged with their code.

    Without ``columns`` each file is read by its own header, and columns that a file lacks are null; there is a scan for each
    header, whatever the number of days and codes.  With ``columns`` there is one scan, and a file whose header
    differs from them fails.  Files outside the range are not opened, nor are their folders listed; a missing file
    is no error.  None if there is no file at all.
    """
    files = source_files(spark, folder, layout, codes, start, end)
    paths = paths_of(files)
    if columns is None:
        scan = read_by_header(spark, files_by_header(spark, paths))
    else:
        scan = read_by_header(spark, {tuple(columns): list(paths.values())} if paths else {})
    if scan is None:
        return None
    tags = [layout.code_of(FILE).alias(code_name)]
    if day_name:
        tags.append(layout.day_of(FILE).cast("date").alias(day_name))
    return scan.select(*(F.col(f"`{name}`") for name in scan.columns if name != FILE), *tags)


def read_backfill(
    spark: SparkSession, folder: str, codes: Sequence[str], glob: str = BACKFILL_GLOB, code_name: str = "airport_code"
) -> DataFrame:
    """The one-time history, one file per code, each by its own header; every code must have its file.

    Rows are tagged with their code and their file.
    """
    layout = DatedCsv(glob)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = if_present(lambda: reader.option("pathGlobFilter", layout.name_filter(codes)).load(folder))
    # One file per code, so the list of names is as short as the list of codes.
    paths = {} if files is None else paths_of(files.select("path", F.col("_metadata.file_path").alias(FILE)))
    found = {posixpath.basename(path).split("_")[0] for path in paths.values()}
    absent = [code for code in codes if code not in found]
    if absent:
        raise FileNotFoundError(f"no backfill file below {folder} for {', '.join(absent)}")
    scan = read_by_header(spark, files_by_header(spark, paths))
    if scan is None:
        raise ValueError(f"the backfill files below {folder} are empty")
    return scan.withColumn(code_name, layout.code_of(FILE))


def list_inputs(
    spark: SparkSession, folder: str, layout: DatedCsv, codes: Sequence[str], start: str, end: str
) -> DataFrame:
    """Day and code of every input file present, from the listing alone."""
    files = source_files(spark, folder, layout, codes, start, end)
    return files.select(F.col("day").cast("date").alias("day"), "code")


def expected_inputs(codes: DataFrame, start: str, end: str, code: str = "code", day: str = "day") -> DataFrame:
    """Every day of the range for every code."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    return codes.select(F.explode(days).alias(day), code)


def missing_partitions(
    codes: DataFrame, found: DataFrame, start: str, end: str, code: str = "code", day: str = "day"
) -> DataFrame:
    """Expected days × codes for which nothing was found."""
    present = found.select(day, code).dropDuplicates()
    return expected_inputs(codes, start, end, code, day).join(present, [day, code], "left_anti")
