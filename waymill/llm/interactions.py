"""How document filters interact: what each removes, repeats and loses under every order of application."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import match_unique
from ..storage import materialize, new_folder
from .arrays import released
from .columns import WORD

# With so many filters there are 5,040 orders, each with a row for each part and step.
_MOST_FILTERS = 7


def text_failures(text: Column) -> dict[str, Column]:
    """The rules on a text by itself: A few words, B few distinct words, C many capitals, D signs of markup.

    The text must not be null.  Words are those of ``columns.WORD``, as they are written.
    """
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def judge_documents(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "source", copies: str = "E"
) -> DataFrame:
    """(``part``, one boolean for each filter, ``good``, ``toxic``) for each document: which filters it fails, and its labels.

    Beside the rules of ``text_failures`` a document fails ``copies`` if a smaller key has the same text.  Texts are told
    apart by their SHA-256, so that a row of some 60 bytes travels and not the text; the least key of each text is found by
    an aggregation within the tasks first, and met in a join whose hot keys are split.

    A null text counts as empty, a null part as the empty string.  Null keys have no label, and are neither copies nor
    what others copy; equal keys (repeated rows) are no copies of each other.  A key is good or toxic if one of its labels
    says so.  Other columns are not used.  Empty tables give an empty result.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    rules = [failed.alias(name) for name, failed in text_failures(F.col("whole")).items()]
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole.alias("whole"))
    own = own.select("key", "part", F.unhex(F.sha2("whole", 256)).alias("digest"), *rules)
    own = materialize(own, new_folder(spark, "failures"))
    least = own.filter("key is not null").groupBy("digest").agg(F.min("key").alias("least"))
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
    marks = marks.agg(*(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))))
    judged = match_unique(match_unique(own, least, ["digest"], "left"), marks, ["key"], "left")
    return judged.select(
        "part",
        *text_failures(F.lit("")),
        F.coalesce(F.col("key") > F.col("least"), F.lit(False)).alias(copies),
        *(F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")),
    )


def removal_steps(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """The orders of so many filters (a row each), and the step at which each order removes each set of failed filters.

    A set is a bit mask.  Its row of the mask matrix holds 0 for a filter that is failed and a large number otherwise; an
    order's row of the position matrix (its inverse permutation) holds the step of each filter.  Combined by addition and
    minimum, as a matrix product, they give the first step whose filter is failed; ``filters + 1`` stands for none.
    """
    orders = np.array(list(permutations(range(filters))), np.int64).reshape(-1, filters)
    positions = np.argsort(orders, axis=1) + 1
    failed = (np.arange(1 << filters)[:, None] >> np.arange(filters)) & 1
    masks = np.where(failed == 1, 0, filters + 1)
    steps = np.full((len(orders), 1 << filters), filters + 1, np.int64)
    for f in range(filters):
        np.minimum(steps, positions[:, f, None] + masks[None, :, f], out=steps)
    return orders, steps


def order_counts(weights: np.ndarray, orders: np.ndarray, steps: np.ndarray) -> Mapping[str, np.ndarray]:
    """Counts of one part for each order and step; ``weights`` has for each mask its documents, good ones and toxic ones."""
    filters = orders.shape[1]
    some = np.flatnonzero(weights[:, 0])
    # Each mask's weight is scattered to the step that removes it; the last column takes what stays.
    lost = np.zeros((3, len(orders), filters + 1), np.int64)
    row = np.arange(len(orders))
    for mask in some.tolist():
        for kind in range(3):
            lost[kind, row, steps[:, mask] - 1] += weights[mask, kind]
    removed = lost[0, :, :filters]
    fails = (some[None, None, :] >> orders[:, :, None]) & 1
    earlier = steps[:, None, some] < np.arange(1, filters + 1)[None, :, None]
    by_filter = np.zeros(filters, np.int64)
    np.add.at(by_filter, orders, removed)
    return {
        "kept": weights[:, 0].sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": (fails * earlier) @ weights[some, 0],
        "unique_fails": weights[1 << orders, 0],
        "good_lost": lost[1, :, :filters],
        "toxic_lost": lost[2, :, :filters],
        "shapley": by_filter[orders],
    }


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_filters(judged: DataFrame, filters: str) -> DataFrame:
    """For each part, order of the filters and step: what the step keeps, removes and loses, and what it repeats.

    ``judged`` has ``part``, a boolean column for each letter of ``filters`` (null: not failed), ``good`` and ``toxic``.
    It is counted by part and set of failed filters, within the tasks first, so that a part comes to one row with at most
    2^filters counts, whatever its documents; from these all orders are worked out.

    ``kept``: documents left after the step; ``removed``: those that it removes; ``redundant``: those that fail its filter and
    went earlier; ``unique_fails``: those that fail no other filter; ``good_lost`` and ``toxic_lost``: labelled ones among the
    removed; ``shapley``: documents that its filter removes, summed over all orders.  A part of which nothing fails has its
    rows too; an empty table gives an empty result.  Repeated rows count each.
    """
    if len(set(filters)) != len(filters) or not 0 < len(filters) <= _MOST_FILTERS:
        raise ValueError(f"filters must be one to {_MOST_FILTERS} different letters")
    orders, steps = removal_steps(len(filters))
    names = ["".join(filters[f] for f in order) for order in orders.tolist()]

    mask = sum((F.when(F.col(name), 1 << i).otherwise(0) for i, name in enumerate(filters)), F.lit(0))
    counts = [F.count("*").alias("n"), *(F.sum(F.col(c).cast("long")).alias(c) for c in ("good", "toxic"))]
    by_mask = judged.groupBy("part", mask.alias("mask")).agg(*counts)
    by_part = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))

    def audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = len(names) * len(filters)
        step = pa.array(np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), len(names)))
        order = pa.array(np.repeat(np.array(names, object), len(filters)), pa.string())
        for batch in batches:
            for part, counted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                weights = np.zeros((1 << len(filters), 3), np.int64)
                for c in counted:
                    weights[c["mask"]] = c["n"], c["good"], c["toxic"]
                found = order_counts(weights, orders, steps)
                arrays = [pa.array([part] * each, pa.string()), order, step, *(pa.array(found[c].ravel()) for c in _COUNTS)]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "filter_order", "step", *_COUNTS])

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    return by_part.mapInArrow(released(audited), schema)
