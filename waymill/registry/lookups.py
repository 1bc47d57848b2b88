"""Code → name lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import joined, translate_codes
from ..operators import attach_name, distinct_pairs, one_name_per_code
from ..sources import inline_table
from .tables import Tables, collector

QUERIES, ORACLES, query = collector()


@query("SELECT DISTINCT o_orderstatus AS code, o_orderpriority AS name FROM orders")
def code_name_pairs(t: Tables) -> DataFrame:
    return distinct_pairs(t.orders.select(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("name")))


@query("SELECT p_brand AS code, min(p_name) AS name FROM part GROUP BY 1", name="single_name_per_code")
def one_name_each(t: Tables) -> DataFrame:
    """Codes with several names keep the smallest."""
    return one_name_per_code(t.part.select(F.col("p_brand").alias("code"), F.col("p_name").alias("name")), "code", "name")



@query(
    """
    WITH names AS (SELECT * FROM nation WHERE n_regionkey <> 4)
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, d.n_name AS departure_name, a.n_name AS arrival_name
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN names d ON s.s_nationkey = d.n_nationkey LEFT JOIN names a ON c.c_nationkey = a.n_nationkey
    """
)
def airport_names_both_ends(t: Tables) -> DataFrame:
    """One dimension in two roles; codes of one region have no name."""
    arrivals = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    legs = (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        .join(arrivals, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    names = t.nation.filter("n_regionkey <> 4").select("n_nationkey", "n_name")
    named = attach_name(legs, names, "s_nationkey", "departure_name")
    named = attach_name(named, names, "c_nationkey", "arrival_name")
    return named.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "departure_name", "arrival_name")


@query(
    """
    SELECT c.c_custkey, coalesce(n.n_name, '') AS carrier_names
    FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c.c_nationkey = n.n_nationkey
    """
)
def carrier_name_lookup(t: Tables) -> DataFrame:
    names = t.nation.filter("n_regionkey <> 2").select("n_nationkey", "n_name")
    named = attach_name(t.customer, names, "c_nationkey", "name")
    return named.select("c_custkey", joined(F.array("name")).alias("carrier_names"))


@query(
    """
    SELECT o_orderkey, concat_ws(',', CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END,
                                      CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low' END) AS names
    FROM orders
    """
)
def code_list_translate(t: Tables) -> DataFrame:
    """A fixed mapping applied to each element of an array of codes; unknown codes give null."""
    mapping = {"F": "finished", "O": "open", "1-URGENT": "urgent", "5-LOW": "low"}
    names = translate_codes(F.array("o_orderstatus", "o_orderpriority"), mapping)
    return t.orders.select("o_orderkey", joined(names).alias("names"))


@query(
    """
    SELECT o_orderkey, concat_ws(',', o_orderstatus, nullif(o_orderpriority, '5-LOW')) AS codes FROM orders
    """
)
def joined_list_csv(t: Tables) -> DataFrame:
    codes = F.array("o_orderstatus", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    return t.orders.select("o_orderkey", joined(codes).alias("codes"))


@query(
    """
    SELECT o.o_orderkey, t.label, t.country FROM orders o
    LEFT JOIN (VALUES ('1-URGENT', '나리타', '일본'), ('2-HIGH', '후쿠오카', '일본'), ('3-MEDIUM', '간사이', '일본'))
      t(code, label, country) ON o.o_orderpriority = t.code
    """
)
def inline_dimension(t: Tables) -> DataFrame:
    """A table given in the code, attached to the orders."""
    rows = [("1-URGENT", "나리타", "일본"), ("2-HIGH", "후쿠오카", "일본"), ("3-MEDIUM", "간사이", "일본")]
    dimension = inline_table(t.spark, rows, "o_orderpriority STRING, label STRING, country STRING")
    return t.orders.join(dimension, "o_orderpriority", "left").select("o_orderkey", "label", "country")
