"""Snapshot comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.cdc import snapshot_deletes, snapshot_diff, without_operations
from strata.functions.labels import deleted_flag
from strata.queries.tables import day, table

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def snapshot_deletes_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Landing holds several states per line, returned ones as deletes; the new
    snapshot holds the lines still open."""
    lines = table(spark, folder, "lineitem")
    state = F.when(F.col("l_returnflag") == "R", "1").otherwise("5")
    landed = lines.withColumn("__$operation", state)
    snapshot = lines.filter(F.col("l_linestatus") == "O")
    found = snapshot_deletes(snapshot, landed, LINE_KEYS, LINE_ORDER)
    return found.select(
        *LINE_KEYS, "l_partkey", day("l_shipdate").alias("shipped"), F.col("`__$operation`").alias("operation")
    )


SNAPSHOT_DELETES = """
WITH live AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
  WHERE rn = 1 AND l_returnflag <> 'R'),
snap AS (SELECT * FROM lineitem WHERE l_linestatus = 'O')
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS shipped, '5' AS operation FROM snap
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE), '1' FROM live
WHERE NOT EXISTS (SELECT 1 FROM snap WHERE snap.l_orderkey = live.l_orderkey
                  AND snap.l_linenumber = live.l_linenumber)
"""


def snapshot_diff_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Before: all but urgent orders. After: all but finished ones, pending ones repriced."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    before = orders.filter(F.col("o_orderpriority") != "1-URGENT")
    price = F.col("o_totalprice")
    repriced = F.when(F.col("o_orderstatus") == "P", price * 2).otherwise(price)
    after = orders.filter(F.col("o_orderstatus") != "F").withColumn("o_totalprice", repriced)
    return snapshot_diff(before, after, ["o_orderkey"])


SNAPSHOT_DIFF = """
WITH a AS (SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT'),
b AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2
                             ELSE o_totalprice END AS o_totalprice)
      FROM orders WHERE o_orderstatus <> 'F')
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey, coalesce(b.o_custkey, a.o_custkey) AS o_custkey,
       coalesce(b.o_orderstatus, a.o_orderstatus) AS o_orderstatus,
       coalesce(b.o_orderpriority, a.o_orderpriority) AS o_orderpriority,
       coalesce(b.o_totalprice, a.o_totalprice) AS o_totalprice,
       CASE WHEN a.o_orderkey IS NULL THEN 'I' WHEN b.o_orderkey IS NULL THEN 'D'
            WHEN a.o_totalprice = b.o_totalprice THEN 'N' ELSE 'U' END AS change
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey
"""


def operation_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Operation codes of a capture feed: 3 is a before-image and is left out."""
    kind = F.col("event_type")
    code = F.when(kind == "error", "1").when(kind == "view", "3").when(kind == "signup", "D").when(
        kind == "click", "4"
    )
    events = table(spark, folder, "events").withColumn("__$operation", code)
    operation = F.col("`__$operation`")
    return without_operations(events, ["3"]).select(
        "event_id",
        operation.alias("operation"),
        deleted_flag(operation, "1").alias("deleted_a"),
        deleted_flag(operation, "D").alias("deleted_b"),
    )


OPERATION_FLAGS = """
SELECT event_id, operation, CASE WHEN operation = '1' THEN 'Y' ELSE 'N' END AS deleted_a,
       CASE WHEN operation = 'D' THEN 'Y' ELSE 'N' END AS deleted_b
FROM (SELECT event_id, event_type,
             CASE event_type WHEN 'error' THEN '1' WHEN 'signup' THEN 'D' WHEN 'click' THEN '4' END AS operation
      FROM events) WHERE event_type <> 'view'
"""

QUERIES = {
    "cdc_snapshot_deletes": (snapshot_deletes_lines, SNAPSHOT_DELETES),
    "cdc_snapshot_diff": (snapshot_diff_orders, SNAPSHOT_DIFF),
    "cdc_operation_flags": (operation_flags, OPERATION_FLAGS),
}
