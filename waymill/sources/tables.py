"""Parquet, catalog and inline tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .absence import if_present


def read_daily(spark: SparkSession, folder: str, file_template: str, date: str) -> DataFrame:
    """One day's Parquet file; the template names it by ``{date}``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{file_template.format(date=date)}")


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """What an earlier run has stored, or None on the first run."""
    return if_present(lambda: spark.read.parquet(path))


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog, by its (qualified) name."""
    return spark.table(name)


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table given in the code.

    Handed over as Arrow, it becomes a local relation of known size, which Spark broadcasts;
    plain Python rows would become a scan of unknown size and make joins shuffle the other side.
    """
    fields = StructType.fromDDL(schema)
    records = [dict(zip(fields.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, to_arrow_schema(fields)), fields)
