"""Mix sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import match_unique
from .columns import group_key, refuse_reserved
from .ranks import with_position


def source_targets(
    docs: DataFrame, source: str, size: str, weights: Sequence[int], share: float, most: int
) -> DataFrame:
    """One row per source: ``__key``, ``__weight``, ``__source_size`` and its target size ``__target``.

    Sources are ranked by code point, null last, and take the weights in turn.  Together the
    targets come to ``share`` of all sizes; none is above ``most`` times its source's size, and what
    a source cannot take goes to the others by weight.  Only sums pass through the driver.  A null source is one of its own,
    one without any size has target 0, and an empty table gives no row.
    """
    if not 0 < share <= most:
        raise ValueError("the share must be above 0 and not above the most that documents may repeat")
    if not weights or any(w <= 0 or w != int(w) for w in weights):
        raise ValueError("weights must be positive whole numbers")
    sizes = docs.groupBy(source).agg(F.sum(size).alias("__source_size"))
    sizes = sizes.withColumn("__missing", F.col(source).isNull())
    ranked = with_position(sizes, [], [F.col("__missing"), F.col(source)], "__rank")
    turn = F.array(*(F.lit(int(w)) for w in weights))
    ranked = ranked.select(
        group_key(F.col(source)).alias("__key"),
        F.get(turn, ((F.col("__rank") - 1) % len(weights)).cast("int")).cast("long").alias("__weight"),
        "__source_size",
    )
    cap = F.col("__source_size") * most
    total = ranked.agg(F.sum("__source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.col("__weight") * F.lit(level) > cap
        held, free, count = ranked.agg(
            F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("__weight"))), F.sum(above.cast("long"))
        ).first()
        if not free or (capped >= 0 and count == capped):
            break
        level, capped = (total * share - held) / free, count
    return ranked.withColumn("__target", F.least(F.col("__weight") * F.lit(level), cap.cast("double")))


def mix_sources(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    source: str = "source",
    size: str = "size",
    weights: Sequence[int] = (1, 2, 3),
    share: float = 1,
    most: int = 3,
    seed: int = 0,
) -> DataFrame:
    """The documents with ``copies``, how often the mix takes each, and their source's ``source_size`` and ``target``.

    Within a source every document is expected target / source_size times.  The expected
    copies are summed along the source in order of size, a random offset per source is added, and a
    document is taken once for every whole number that its stretch of the sum crosses.  The
    order by size keeps the words taken within about one largest document of the target.

    Sizes must be whole numbers, not negative, never null.  The result does not depend on the
    partitioning; equal rows are interchangeable.  A null source is a source of its own, null keys
    come first among documents of one size, sources without any words have target 0 and no copies,
    and an empty table gives an empty result.  Input columns named like a result column
    (``copies``, ``source_size``, ``target``) are replaced; names that begin with ``__`` are refused.
    """
    refuse_reserved(docs.columns)
    docs = docs.drop("copies", "source_size", "target")
    targets = source_targets(docs, source, size, weights, share, most)
    keyed = docs.withColumn("__key", group_key(F.col(source)))
    order = [F.col(size), F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.col(key)]
    placed = with_position(keyed, ["__key"], order, "__position")
    placed = match_unique(placed, targets, ["__key"])
    # The offset is an odd multiple of 1/2048, so that adding whole copies to it is exact.
    digest = F.md5(F.concat(F.lit(f"{int(seed)}/"), F.col("__key")).cast("binary"))
    offset = (F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") % 1024 * 2 + 1) / F.lit(2048.0)
    each = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0)
    crossed = F.floor(offset + F.col("__position") * each) - F.floor(offset + (F.col("__position") - 1) * each)
    return placed.select(
        *docs.columns,
        F.least(crossed, F.lit(most)).cast("long").alias("copies"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
    )


def emit_copies(mixed: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it."""
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.filter("copies > 0").withColumn("__row", repeated).drop("__row")
