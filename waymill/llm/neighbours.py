"""Each row together with the row that follows it, without one global sort task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import released


def with_following(
    docs: DataFrame, key: str, text: str, make: Callable[[object, str, str], tuple], schema: str, arrow: pa.Schema
) -> DataFrame:
    """Apply ``make(key, text, next text)`` to every row in ascending order of a whole-number key; the last is followed by the first.

    Rows go to ranges of keys whose bounds are keys that occur, so that the row after a range's last
    is the one with the next range's first key; that row alone is sent to both ranges.  The
    ranges are streamed in order, one row at a time.  Only the bounds pass through the driver,
    four for each shuffle partition.  Null keys come first, rows with equal keys follow each other by
    text, null texts count as empty.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce(F.col("key"), F.lit(-(2**63)))
    fractions = [i / ranges for i in range(1, ranges)]
    lowest, found = rows.agg(F.min(place), F.percentile_approx(place, fractions, 20 * ranges)).first()
    bounds = sorted({b for b in found or [] if b > lowest})
    if bounds:
        # The number of bounds at or below the key, by halving steps.
        steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))))
        # One literal, however many bounds there are.
        known = F.lit(np.array(bounds, np.int64))

        def step(at, width):
            return F.when((at + width <= len(bounds)) & (F.get(known, at + width - 1) <= place), at + width).otherwise(at)

        of = F.aggregate(steps, F.lit(0), step)
        starts = F.array_contains(known, place)
    else:
        of, starts = F.lit(0), F.lit(False)
    copies = F.when(place == F.lit(lowest), F.array(F.lit(0), F.lit(2))).otherwise(
        F.when(starts, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    )
    sent = rows.withColumn("of", of).withColumn("copy", F.explode(copies))
    sent = sent.withColumn("of", F.when(F.col("copy") == 0, F.col("of")).when(F.col("copy") == 1, F.col("of") - 1).otherwise(len(bounds)))
    sent = sent.repartition("of").sortWithinPartitions("of", "copy", F.asc_nulls_first("key"), "text")

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = None, None
        for batch in batches:
            results = []
            columns = zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for key_, value, range_, copy in columns:
                if range_ != of:
                    held, of = None, range_
                if held is None and copy:
                    continue
                text_ = value.as_py()
                if held is not None:
                    results.append(make(*held, text_))
                held = None if copy else (key_, text_)
            arrays = [pa.array([r[i] for r in results], f.type) for i, f in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return sent.select("key", "text", "of", "copy").mapInArrow(released(paired), schema)
