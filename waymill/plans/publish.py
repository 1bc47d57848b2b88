"""Profile a catalog table and publish it as another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import column_profile
from ..sinks import overwrite_parquet, publish_table
from ..sources import catalog_table
from ..storage import materialize, scratch_folder


def profile_and_publish(
    spark: SparkSession,
    source: str,
    target: str,
    path: str | None = None,
    mode: str = "append",
    approximate: bool = False,
    profile_out: str | None = None,
) -> DataFrame:
    """Write the source table to the target table and return the profile of what was written.

    The source is read once, into a snapshot in the shared folder; both the profile and the target
    come from it, so that they agree even where the source changes meanwhile or is the target.  The profile, one row
    per column, is also written to ``profile_out`` (Parquet) if given.
    """
    with scratch_folder(spark, "publish") as work:
        snapshot = materialize(catalog_table(spark, source), f"{work}/snapshot")
        profile = column_profile(snapshot, approximate=approximate)
        # One row per column of the table: this alone passes through the driver.
        result = spark.createDataFrame(profile.collect(), profile.schema)
        publish_table(snapshot, target, path, mode)
    if profile_out:
        overwrite_parquet(result, profile_out)
    return result
