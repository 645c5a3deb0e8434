"""Type 1 and type 2 history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.ordered import latest_per_key
from strata.operators.scd import active_flag, present_scd2, scd1, scd2
from strata.queries.tables import day, table

KEYS = ["user_id"]


def changes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a change feed: one row per user, day and event."""
    return table(spark, folder, "events").select(
        "user_id",
        "event_type",
        "value",
        day("ts").alias("business_date"),
        F.col("event_id").alias("processing_time"),
        F.when(F.col("event_type") == "error", "Y").otherwise("N").alias("Row_Is_Deleted_Ind"),
    )


CHANGES = """
chg AS (SELECT user_id, event_type, value, CAST(ts AS DATE) AS business_date, event_id AS processing_time,
               CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS deleted FROM events)
"""


def scd1_latest(spark: SparkSession, folder: str) -> DataFrame:
    return scd1(changes(spark, folder), KEYS, "business_date", exclude=["value"])


SCD1_LATEST = f"""
WITH {CHANGES}
SELECT user_id, event_type, business_date, processing_time, deleted AS "Row_Is_Deleted_Ind"
FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY business_date DESC, processing_time DESC) AS rn FROM chg) WHERE rn = 1
"""

LINE = "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_returnflag".split()


def scd1_dedup_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    lines = latest_per_key(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return lines.select(*LINE, day("l_shipdate").alias("shipped"))


SCD1_DEDUP = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag,
       CAST(l_shipdate AS DATE) AS shipped
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
WHERE rn = 1
"""


def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    """Event numbers are unique, so no position repeats."""
    versions = scd2(changes(spark, folder), KEYS, "business_date", unique=True)
    return present_scd2(versions.drop("Row_Is_Deleted_Ind"), deleted=None)


def _versions(source: str = "chg") -> str:
    return f"""
ver AS (SELECT *, lead(business_date) OVER (PARTITION BY user_id
        ORDER BY business_date, processing_time) AS end_at FROM {source})
"""


_PRESENTED = """
       business_date AS "Row_Effective_Date",
       CASE WHEN end_at IS NULL OR end_at > business_date THEN 'Y' ELSE 'N' END AS "Row_Is_Active_Ind",
"""
SCD2_HISTORY = f"""
WITH {CHANGES}, {_versions()}
SELECT user_id, event_type, value, business_date, processing_time, {_PRESENTED}
       coalesce(end_at, DATE '9999-12-31') AS "Row_Term_Date", end_at IS NULL AS is_current
FROM ver
"""


def scd2_soft_delete(spark: SparkSession, folder: str) -> DataFrame:
    versions = scd2(changes(spark, folder), KEYS, "business_date", exclude=["value"])
    return present_scd2(versions)


SCD2_SOFT_DELETE = f"""
WITH {CHANGES}, {_versions()}
SELECT user_id, event_type, business_date, processing_time, deleted AS "Row_Is_Deleted_Ind", {_PRESENTED}
       CASE WHEN deleted = 'Y' THEN business_date ELSE coalesce(end_at, DATE '9999-12-31') END AS "Row_Term_Date",
       end_at IS NULL AND deleted = 'N' AS is_current
FROM ver
"""


def scd2_track_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Versions only where the event type changes."""
    versions = scd2(changes(spark, folder), KEYS, "business_date", track=["event_type"])
    return versions.select("user_id", "event_type", "processing_time", "start_at", "end_at")


SCD2_TRACK = f"""
WITH {CHANGES},
moved AS (SELECT * FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id
          ORDER BY business_date, processing_time) AS before FROM chg)
          WHERE before IS NULL OR before <> event_type), {_versions("moved")}
SELECT user_id, event_type, processing_time, business_date AS start_at, end_at FROM ver
"""


def scd2_timestamp_sequence(spark: SparkSession, folder: str) -> DataFrame:
    """History ordered by a timestamp instead of a date."""
    events = table(spark, folder, "events").select("user_id", "event_type", "ts", "event_id")
    versions = scd2(events, KEYS, "ts", "event_id", unique=True)
    return versions.select("event_id", "user_id", "event_type", "start_at", "end_at")


SCD2_TIMESTAMP = """
SELECT event_id, user_id, event_type, ts AS start_at,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_at
FROM events
"""


def scd2_active_flag(spark: SparkSession, folder: str) -> DataFrame:
    """The last order state of each customer, priority and day is the active one."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", day("o_orderdate").alias("business_date")
    )
    return active_flag(
        orders, ["o_custkey"], F.trunc("business_date", "month"), tie="o_orderkey", out="active"
    )


SCD2_ACTIVE = """
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS business_date,
       CASE WHEN rank() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)
            ORDER BY o_orderkey DESC) = 1 THEN 'Y' ELSE 'N' END AS active
FROM orders
"""

QUERIES = {
    "scd1_latest": (scd1_latest, SCD1_LATEST),
    "scd1_dedup_lineitem": (scd1_dedup_lineitem, SCD1_DEDUP),
    "scd2_history": (scd2_history, SCD2_HISTORY),
    "scd2_soft_delete": (scd2_soft_delete, SCD2_SOFT_DELETE),
    "scd2_track_columns": (scd2_track_columns, SCD2_TRACK),
    "scd2_timestamp_sequence": (scd2_timestamp_sequence, SCD2_TIMESTAMP),
    "scd2_active_flag": (scd2_active_flag, SCD2_ACTIVE),
}
