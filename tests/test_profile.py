"""Column profiles of narrow, wide and odd tables."""

from __future__ import annotations

import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from waymill.operators import column_profile

def scans(df):
    return len(re.findall(r"FileScan parquet|Scan parquet", df._jdf.queryExecution().executedPlan().toString()))


@pytest.fixture
def odd(spark):
    rows = spark.range(200).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 10).alias("a.b"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), (F.col("id") % 4).cast("string"))).alias("text"),
        F.when(F.col("id") % 4 == 0, F.lit(0.0)).when(F.col("id") % 4 == 1, F.lit(-0.0)).when(F.col("id") % 4 == 2, F.lit(float("nan"))).alias("number"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("day"),
        F.timestamp_seconds(F.col("id") % 9).alias("at"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("wall"),
        (F.col("id") / 8).cast("decimal(10,2)").alias("price"),
        F.col("id").cast("string").cast("binary").alias("raw"),
        (F.col("id") % 2 == 0).alias("flag"),
        F.array((F.col("id") % 2).cast("int"), F.lit(None).cast("int")).alias("list"),
        F.struct((F.col("id") % 6).cast("int").alias("x"), F.lit(None).cast("string").alias("y")).alias("pair"),
        F.create_map(F.lit("k"), F.col("id").cast("int")).alias("map"),
        F.lit(None).cast("string").alias("nothing"),
        F.when(F.col("id") < 0, F.col("id")).alias("empty"),
    )
    return rows


DISTINCT = {
    "a.b": 10, "text": 4, "number": 2, "day": 7, "at": 9, "wall": 1, "price": 200, "raw": 200, "flag": 2, "list": 2, "pair": 6, "map": None,
    "nothing": 0, "empty": 0,
}


@pytest.mark.parametrize("batch", [1, 2, 32])
def test_every_type(odd, batch):
    found = column_profile(odd, batch=batch).collect()
    assert [r["column_name"] for r in found] == odd.columns
    assert {r["column_name"]: r["n_distinct"] for r in found} == DISTINCT
    nulls = Counter({name: odd.filter(F.col(f"`{name}`").isNull()).count() for name in odd.columns})
    assert {r["column_name"]: r["n_null"] for r in found} == nulls and {r["n_rows"] for r in found} == {200}
    ends = {r["column_name"]: (r["min_value"], r["max_value"]) for r in found}
    assert ends["a.b"] == ("0", "9") and ends["text"] == ("t0", "t3") and ends["day"] == ("2024-01-01", "2024-01-07")
    assert ends["price"] == ("0.00", "24.88") and ends["number"][1] == "NaN" and ends["nothing"] == ends["map"] == (None, None)


def test_estimates_have_the_same_columns(odd):
    exact, about = column_profile(odd), column_profile(odd, approximate=True)
    assert about.schema == exact.schema
    for one, other in zip(exact.collect(), about.collect()):
        assert one.asDict() | {"n_distinct": 0} == other.asDict() | {"n_distinct": 0}
        assert one["n_distinct"] is None or abs(one["n_distinct"] - other["n_distinct"]) <= 0.1 * one["n_distinct"]


def test_no_rows_and_chosen_columns(odd):
    found = column_profile(odd.limit(0), ["text", "map"]).collect()
    assert [tuple(r) for r in found] == [("text", 0, 0, 0, None, None), ("map", 0, 0, None, None, None)]


def test_a_wide_table_takes_a_scan_for_each_batch(spark, tmp_path):
    kinds = ("(id * {k}) % 7", "cast(id % {k} as string)", "id / {k}")
    wide = spark.range(10).select(*(F.expr(kinds[i % 3].format(k=i + 1)).alias(f"c{i}") for i in range(300)))
    wide.write.parquet(str(tmp_path / "wide"))
    stored = spark.read.parquet(str(tmp_path / "wide"))
    start = time.perf_counter()
    profile = column_profile(stored, batch=50)
    found = profile.collect()
    assert time.perf_counter() - start < 30
    # Three types of a hundred columns in batches of fifty, and one pass that only counts rows.
    assert scans(column_profile(stored, batch=50)) == 7
    plain = wide.toPandas()
    assert [r["n_distinct"] for r in found] == [plain[c].nunique() for c in plain.columns]


def test_a_hot_value_is_counted_before_the_shuffle(spark, tmp_path):
    spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5).alias("v")).write.parquet(str(tmp_path / "hot"))
    profile = column_profile(spark.read.parquet(str(tmp_path / "hot")))
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "functions=[partial_count(1)]" in plan
    assert profile.first()["n_distinct"] == 5
