"""Target lists, renaming, two-direction feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import branch_counts as counts_per_branch
from ..operators import keep_targets, rename_columns, union_all
from ..plans import daily_operations
from ..sources import inline_table
from .tables import Tables, collector

QUERIES, ORACLES, query = collector()

_FLIGHTS = """
    SELECT 'D' AS operation_type, o_orderkey AS flight_number, o_orderdate AS actual_time, o_orderstatus AS status
    FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (0, 5, 10, 15)) AND o_orderstatus IN ('F', 'P')
    UNION ALL
    SELECT 'A', l_orderkey, l_shipdate, l_returnflag
    FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (0, 5, 10, 15))
      AND l_returnflag IN ('A', 'R') AND l_linestatus = 'F'
"""


def _target_nations(t: Tables) -> DataFrame:
    return inline_table(t.spark, [(0,), (5,), (10,), (15,)], "nation INT")


@query(
    """
    SELECT o.* FROM orders o
    WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_nationkey IN (0, 5, 10, 15))
      AND o_orderstatus IN ('F', 'P') AND o_orderpriority = '1-URGENT'
    """
)
def target_filter(t: Tables) -> DataFrame:
    customers = keep_targets(t.customer, _target_nations(t), "c_nationkey")
    wanted = F.col("o_orderstatus").isin("F", "P") & (F.col("o_orderpriority") == "1-URGENT")
    return keep_targets(t.orders, customers, "o_custkey", "c_custkey", where=wanted)


def _flights(t: Tables) -> DataFrame:
    targets = _target_nations(t)
    departures = keep_targets(
        t.orders,
        keep_targets(t.customer, targets, "c_nationkey"),
        "o_custkey",
        "c_custkey",
        where=F.col("o_orderstatus").isin("F", "P"),
    )
    arrivals = keep_targets(
        t.lineitem,
        keep_targets(t.supplier, targets, "s_nationkey"),
        "l_suppkey",
        "s_suppkey",
        where=F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "F"),
    )
    names = {
        "flight_number": ("o_orderkey", "l_orderkey"),
        "actual_time": ("o_orderdate", "l_shipdate"),
        "status": ("o_orderstatus", "l_returnflag"),
    }
    return union_all(
        [
            rename_columns(side, {pair[i]: name for name, pair in names.items()}).select(
                F.lit(kind).alias("operation_type"), *names
            )
            for i, (kind, side) in enumerate([("D", departures), ("A", arrivals)])
        ]
    )


@query(_FLIGHTS)
def two_direction_union(t: Tables) -> DataFrame:
    return _flights(t)


@query(
    f"""
    SELECT CASE WHEN grouping(operation_type) = 1 THEN 'total' ELSE operation_type END AS branch, count(*) AS n
    FROM ({_FLIGHTS}) GROUP BY ROLLUP (operation_type)
    """
)
def branch_counts(t: Tables) -> DataFrame:
    return counts_per_branch(_flights(t), "operation_type")


@query(
    "SELECT event_id AS flight_number, ts AS actual_time, event_type AS status, user_id, value, props FROM events",
    name="rename_columns",
)
def rename_columns_once(t: Tables) -> DataFrame:
    """An absent source name is ignored."""
    names = {"event_id": "flight_number", "ts": "actual_time", "event_type": "status", "absent": "nowhere"}
    return rename_columns(t.events, names)



@query(
    """
    WITH airport AS (
      SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'NRT' WHEN 1 THEN 'FUK' WHEN 2 THEN 'KIX' ELSE 'LAX' END AS code
      FROM nation)
    SELECT 'D' AS operation_type, cast(o_orderdate AS varchar) AS date, o_orderpriority AS airline,
           cast(o_orderkey AS varchar) AS flight_number, 'ICN' AS departure_airport_code, code AS arrival_airport_code,
           CASE o_orderstatus WHEN 'F' THEN '출발' WHEN 'O' THEN '지연' ELSE '도착' END AS status
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN airport ON c_nationkey = n_nationkey
    WHERE code <> 'LAX' AND o_orderstatus IN ('F', 'O') AND c_mktsegment <> 'MACHINERY'
    UNION ALL
    SELECT 'A', cast(l_shipdate AS varchar), l_linestatus, cast(l_orderkey AS varchar), code, 'ICN',
           CASE l_returnflag WHEN 'A' THEN '도착' WHEN 'R' THEN '취소' ELSE '출발' END
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN airport ON s_nationkey = n_nationkey
    WHERE code <> 'LAX' AND l_returnflag IN ('A', 'R') AND l_linestatus = 'O'
    """
)
def daily_operations_job(t: Tables) -> DataFrame:
    """The whole operations job: source names, target list, statuses and category of each direction."""
    region = F.col("n_regionkey")
    code = F.when(region == 0, "NRT").when(region == 1, "FUK").when(region == 2, "KIX").otherwise("LAX")
    airports = t.nation.select("n_nationkey", code.alias("code"))
    passenger = F.lit(schemas.PASSENGER_CATEGORY)

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    def recoded(column: str, names: dict[str, str], other: str) -> Column:
        return F.coalesce(*(F.when(F.col(column) == code, name) for code, name in names.items()), F.lit(other))

    departures = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(airports, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.lit("D").alias("출/도착구분"),
            text("o_orderdate").alias("날짜"),
            F.col("o_orderpriority").alias("항공사"),
            text("o_orderkey").alias("편명"),
            F.lit("ICN").alias("출발공항코드"),
            F.col("code").alias("도착공항코드"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "화물").otherwise(passenger).alias("구분"),
            recoded("o_orderstatus", {"F": "출발", "O": "지연"}, "도착").alias("현황"),
        )
    )
    arrivals = (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(airports, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.lit("A").alias("출/도착구분"),
            text("l_shipdate").alias("날짜"),
            F.col("l_linestatus").alias("항공사"),
            text("l_orderkey").alias("편명"),
            F.col("code").alias("출발공항코드"),
            F.lit("ICN").alias("도착공항코드"),
            F.when(F.col("l_linestatus") == "F", "화물").otherwise(passenger).alias("구분"),
            recoded("l_returnflag", {"A": "도착", "R": "취소"}, "출발").alias("현황"),
        )
    )
    targets = inline_table(t.spark, schemas.TARGET_AIRPORTS, schemas.TARGET_AIRPORTS_SCHEMA)
    return daily_operations(departures, arrivals, targets).drop("category")
