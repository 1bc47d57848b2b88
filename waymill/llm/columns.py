"""Column expressions that several operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word: a run of characters other than space and the control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(key: Column, parts: int) -> Column:
    """crc32 of a key written as text, modulo ``parts``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % parts


def group_key(value: Column) -> Column:
    """A text that is never null and differs where the values differ, null among them."""
    return F.when(value.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), value.cast("string")))


def refuse_reserved(names: Iterable[str]) -> None:
    """Operators add columns whose names begin with two underscores; an input must not have such names."""
    taken = sorted(name for name in names if name.startswith("__"))
    if taken:
        raise ValueError(f"column names that begin with two underscores are reserved: {', '.join(taken)}")
