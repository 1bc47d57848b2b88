"""Sinks, checked by reading back what was written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import newer_than, read_mark
from ..sinks import append_if_any, append_parquet, export_csv, overwrite_parquet, publish_table
from ..sources import catalog_table
from ..storage import new_folder
from .tables import Tables, collector

QUERIES, ORACLES, query = collector()


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")


@query(
    """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    UNION ALL SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    """
)
def parquet_append_roundtrip(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "append")
    append_parquet(_orders(t), folder)
    append_parquet(_orders(t), folder, compact=True)
    return t.spark.read.parquet(folder)


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def parquet_overwrite_roundtrip(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "overwrite")
    overwrite_parquet(_orders(t), folder)
    overwrite_parquet(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate", "o_totalprice"), folder)
    return t.spark.read.parquet(folder)


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def empty_batch_guard(t: Tables) -> DataFrame:
    """The second run finds nothing newer than its mark and leaves the target as it is."""
    folder = new_folder(t.spark, "guard")
    append_if_any(_orders(t), folder)
    mark = read_mark(t.spark.read.parquet(folder), "o_orderdate")
    append_if_any(newer_than(_orders(t), "o_orderdate", mark), folder)
    return t.spark.read.parquet(folder)


@query("SELECT o_orderkey, concat_ws(',', o_orderstatus, nullif(o_orderpriority, '5-LOW')) AS codes FROM orders")
def csv_export_roundtrip(t: Tables) -> DataFrame:
    folder = new_folder(t.spark, "csv")
    codes = F.array("o_orderstatus", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))).alias("codes")
    export_csv(t.orders.select("o_orderkey", codes), folder, ["codes"])
    return t.spark.read.option("header", True).schema("o_orderkey BIGINT, codes STRING").csv(folder)


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def catalog_publish(t: Tables) -> DataFrame:
    """Written as a Snappy table and read by name; the name is dropped again, the files stay."""
    table = f"waymill_published_{uuid.uuid4().hex}"
    publish_table(_orders(t), table, new_folder(t.spark, "published"))
    published = catalog_table(t.spark, table)
    t.spark.sql(f"DROP TABLE {table}")
    return published


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus <> 'F'")
def catalog_replace(t: Tables) -> DataFrame:
    """A published table whose rows are replaced twice; the name is dropped again, the files stay."""
    table = f"waymill_replaced_{uuid.uuid4().hex}"
    folder = new_folder(t.spark, "replaced")
    publish_table(_orders(t), table, folder, "overwrite")
    for without in ("O", "F"):
        rest = t.orders.filter(F.col("o_orderstatus") != without)
        publish_table(rest.select("o_totalprice", "o_orderkey", "o_orderdate"), table, folder, "overwrite")
    replaced = catalog_table(t.spark, table)
    t.spark.sql(f"DROP TABLE {table}")
    return replaced
