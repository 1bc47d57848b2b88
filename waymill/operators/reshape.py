"""Renaming, target lists and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import match_unique


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename in one step; a source name that is absent is ignored."""
    clashes = sorted(
        target
        for target in set(names.values())
        if len([c for c in df.columns if names.get(c, c) == target]) > 1
    )
    if clashes:
        raise ValueError(f"more than one column would be named {', '.join(clashes)}")
    return df.withColumnsRenamed(dict(names))


def keep_targets(
    df: DataFrame,
    targets: DataFrame,
    code: str,
    target_code: str | None = None,
    where: Column | None = None,
    aggregated: bool = False,
) -> DataFrame:
    """Rows whose code is in the target list and for which ``where`` holds; columns stay as they are.

    A semi join: repeated targets do not repeat rows, and no column has to be dropped afterwards.
    The conditions go below it, down to the scan, and Spark can put a Bloom filter of a selective
    target list there, too.  ``aggregated`` says that the list comes from an aggregation by its code
    and is not small: then hot codes of ``df`` can be split (``match_unique``), but there is no such filter.
    """
    kept = df if where is None else df.filter(where)
    listed = targets.select(F.col(target_code or targets.columns[0]).alias(code))
    joined = match_unique(kept, listed, [code], "left_semi") if aggregated else kept.join(listed, code, "left_semi")
    return joined.select(*df.columns)


def union_all(branches: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all branches, columns matched by name; ``allow_missing`` gives nulls where a branch lacks a column."""
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=allow_missing), branches)
