"""Several tables written as one: staged beside the target, and published together by one marker.

The tables of a target are folders that begin with its name.  A run writes its rows to a staging folder, a subfolder for each
table.  Then it creates the marker: from here on the run counts, and before it nothing of it does.  Last, the staged files are moved
into their tables and the staging folder goes.  ``finish_run`` brings a target to one of the two sides wherever a
run was broken off: with the marker it moves what is left, without it it throws the staged rows away.  Jobs call it before they
read their state.  One run at a time may write to a target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..storage import file_system

_STAGED = "-staged"
_MARKER = "PUBLISHED"
_ROWS = "rows"


class StagedRun:
    """Rows for the tables of a target; nobody sees them before ``publish``."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        finish_run(spark, target)

    def add(self, df: DataFrame, table: str = "", compact: bool = False) -> None:
        """Rows for the folder named ``target`` + ``table``; ``compact`` writes few files, one for a small batch."""
        rows = df.hint("rebalance") if compact else df
        rows.write.mode("errorifexists").parquet(f"{self.target}{_STAGED}/{_ROWS}{table}")

    def publish(self) -> None:
        files, staged = file_system(self.spark, self.target + _STAGED)
        if files.exists(staged):
            files.create(file_system(self.spark, f"{self.target}{_STAGED}/{_MARKER}")[1], False).close()
            finish_run(self.spark, self.target)


def finish_run(spark: SparkSession, target: str) -> None:
    """Carry a broken run through if it was published, else undo it; nothing happens where none was broken off."""
    target = target.rstrip("/")
    files, staged = file_system(spark, target + _STAGED)
    if not files.exists(staged):
        return
    if files.exists(file_system(spark, f"{target}{_STAGED}/{_MARKER}")[1]):
        for table in files.listStatus(staged):
            if table.isDirectory():
                _move(spark, files, table.getPath(), target + table.getPath().getName().removeprefix(_ROWS))
    files.delete(staged, True)


def _move(spark: SparkSession, files, source, target: str) -> None:
    """Move data files into a table's folder; their names are unique, so that what has been moved is not there any more."""
    files.mkdirs(file_system(spark, target)[1])
    for status in files.listStatus(source):
        name = status.getPath().getName()
        if name.startswith("part-") and not files.rename(status.getPath(), file_system(spark, f"{target}/{name}")[1]):
            raise OSError(f"cannot move {name} to {target}")
