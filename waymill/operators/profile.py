"""Counts per branch and data-quality profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, CalendarIntervalType, DataType, MapType, StructType, VariantType


def branch_counts(df: DataFrame, branch: str, total: str = "total") -> DataFrame:
    """Row counts per branch and in all, from one pass.

    The total is rolled up from the counts, not from the rows.
    """
    counts = df.groupBy(branch).agg(F.count("*").alias("n"))
    return (
        counts.rollup(branch)
        .agg(F.sum("n").alias("n"), F.grouping(branch).alias("is_total"))
        .select(F.when(F.col("is_total") == 1, F.lit(total)).otherwise(F.col(branch)).alias("branch"), "n")
    )


def _ordered(kind: DataType) -> bool:
    """Whether values of the type have an order, and so a least and distinct ones."""
    if isinstance(kind, StructType):
        return all(_ordered(field.dataType) for field in kind.fields)
    if isinstance(kind, ArrayType):
        return _ordered(kind.elementType)
    return not isinstance(kind, (MapType, VariantType, CalendarIntervalType))


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False, batch: int = 32
) -> DataFrame:
    """Rows, nulls, distinct values, least and greatest value (as text) of each column.

    Columns of one type are taken ``batch`` at a time: each row gives a (column number, value) pair for every value that is not null, the
    pairs are counted by hash within the tasks first, and only a task's distinct pairs are shuffled.  All facts of
    those columns come from these counts, so that there is one scan for each batch (of its columns alone), a row is widened
    to ``batch`` pairs at most, and the plan grows by a few nodes a batch, not a column.

    ``approximate=True`` estimates the distinct values with a sketch, in one pass for all columns.  Types without an order,
    as maps, have no distinct, least and greatest values (null); they are counted in that pass too.  Names may hold dots.
    The result is in the order of the columns.
    """
    names = list(columns or df.columns)
    kinds = {name: df.schema[name].dataType for name in names}
    column = {name: F.col("`" + name.replace("`", "``") + "`") for name in names}
    exact = [name for name in names if _ordered(kinds[name]) and not approximate]
    rest = [(i, name) for i, name in enumerate(names) if name not in exact]
    totals = df.agg(F.count("*").alias("n_rows"), *(_fact(i, column[name], kinds[name]).alias(f"fact_{i}") for i, name in rest))
    parts = [_counted(df, [(names.index(name), column[name]) for name in some]) for some in _batches(exact, kinds, batch)]
    if rest:
        sketched = totals.select(F.explode(F.array(*(f"fact_{i}" for i, _ in rest))).alias("fact"))
        parts.append(sketched.select("fact.*"))
    facts = reduce(DataFrame.unionByName, parts)
    listed = F.posexplode(F.array(*map(F.lit, names))).alias("number", "column_name")
    rows = totals.select("n_rows", listed).join(facts, "number", "left")
    found = F.coalesce("n_values", F.lit(0))
    # A column that holds nothing has no counts.
    ordered = F.array(*(F.lit(_ordered(kinds[name])) for name in names))
    distinct = F.when(F.get(ordered, F.col("number")), F.coalesce("n_distinct", F.lit(0))).cast("long")
    rows = rows.select(
        "number", "column_name", "n_rows", (F.col("n_rows") - found).alias("n_null"), distinct.alias("n_distinct"), "min_value", "max_value"
    )
    return rows.orderBy("number").drop("number")


def _batches(names: Sequence[str], kinds: dict[str, DataType], size: int) -> list[list[str]]:
    """The names in groups of one type and at most ``size``."""
    by_kind: dict[str, list[str]] = {}
    for name in names:
        by_kind.setdefault(kinds[name].json(), []).append(name)
    return [some[i : i + size] for some in by_kind.values() for i in range(0, len(some), size)]


def _counted(df: DataFrame, columns: Sequence[tuple[int, Column]]) -> DataFrame:
    """Facts of columns of one type, each given with its number, from the counts of their distinct values."""
    pairs = F.inline(F.array(*(F.struct(F.lit(i).alias("number"), value.alias("value")) for i, value in columns)))
    counts = df.select(pairs).filter("value is not null").groupBy("number", "value").agg(F.count("*").alias("n"))
    return counts.groupBy("number").agg(
        F.sum("n").alias("n_values"),
        F.count("*").alias("n_distinct"),
        F.min("value").cast("string").alias("min_value"),
        F.max("value").cast("string").alias("max_value"),
    )


def _fact(number: int, value: Column, kind: DataType) -> Column:
    """Facts of a column from one pass over the rows, with a sketch of its distinct values."""
    nothing = F.lit(None).cast("string")
    ordered = _ordered(kind)
    return F.struct(
        F.lit(number).alias("number"),
        F.count(value).alias("n_values"),
        (F.approx_count_distinct(value) if ordered else F.lit(None).cast("long")).alias("n_distinct"),
        (F.min(value).cast("string") if ordered else nothing).alias("min_value"),
        (F.max(value).cast("string") if ordered else nothing).alias("max_value"),
    )
