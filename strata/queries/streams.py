"""Streaming twins: the same results from a feed that arrives in pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.bronze import to_bronze
from strata.operators.quality import Rule
from strata.operators.scd import present_scd2
from strata.queries import history
from strata.queries.tables import table
from strata.session import new_folder
from strata.sources import landing
from strata.streaming import flows

#: files of a batch, whatever the size of the feed
FILES = 512


def _landed(spark: SparkSession, rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a feed by business date and open it as a stream of batches of fixed size.

    Files of all dates come in no particular order, so later dates may arrive first.
    """
    place = new_folder(spark, name)
    landing.append(rows, place)
    landed = spark.read.parquet(place)
    return flows.read_folder(spark, place, landed.schema, FILES), place


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.date_format("ts", "yyyyMMddHHmm").alias("loadtimestamp"),
        F.lit("Not Used").alias("source"),
        F.lit("feed").alias("source_schema"),
        F.date_format("ts", "yyyy-MM-dd").alias("business_date"),
    )


COLUMNS = [
    "event_id", "user_id", "event_type", "value", "loadtimestamp", "source", "source_schema",
    "business_date",
]


def _typed(df: DataFrame) -> DataFrame:
    return to_bronze(df, COLUMNS, 1744070400)


def stream_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Landing to bronze in two runs; the first halves of all months arrive between them, late."""
    events = _events(spark, folder)
    late = F.dayofmonth(F.to_date("business_date")) <= 15
    stream, place = _landed(spark, events.filter(~late), "feed")
    flows.flow(stream, f"{place}-state", f"{place}-bronze", _typed)
    arriving = events.filter(late).hint("rebalance", F.col("business_date"))
    arriving.write.mode("append").partitionBy("business_date").parquet(place)
    flows.flow(stream, f"{place}-state", f"{place}-bronze", _typed)
    rows = flows.read_batches(spark, f"{place}-bronze")
    shown = F.date_format("loadtimestamp", "yyyy-MM-dd HH:mm:ss")
    return rows.select("event_id", "user_id", "business_date", "processing_time", shown.alias("loaded"))


STREAM_BRONZE = """
SELECT event_id, user_id, CAST(ts AS DATE) AS business_date, CAST(1744070400 AS BIGINT) AS processing_time,
       strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS loaded
FROM events
"""

EVENT_RULES = [
    Rule("FAIL", "event_id is null"),
    Rule("QUARANTINE", "event_type = 'error'"),
    Rule("WARN", "value > 100"),
]


def _refined(spark: SparkSession, folder: str) -> str:
    stream, place = _landed(spark, _events(spark, folder), "checked")
    flows.refine(
        stream,
        f"{place}-state",
        _typed,
        EVENT_RULES,
        lambda df: df,
        f"{place}-clean",
        f"{place}-audit",
        ("D_User", "DF_Event", "events"),
    )
    return place


def stream_dq_clean(spark: SparkSession, folder: str) -> DataFrame:
    rows = flows.read_batches(spark, f"{_refined(spark, folder)}-clean")
    return rows.select("event_id", "user_id", "event_type", "business_date")


STREAM_DQ_CLEAN = """
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS business_date FROM events WHERE event_type <> 'error'
"""


def stream_dq_audit(spark: SparkSession, folder: str) -> DataFrame:
    rows = flows.read_batches(spark, f"{_refined(spark, folder)}-audit")
    return rows.select(
        "target_table",
        "validated_table",
        "dq_type",
        "business_date",
        F.array_join(F.map_keys("reason"), " | ").alias("rules"),
        F.get_json_object("input_details", "$.event_id").cast("bigint").alias("event_id"),
    )


STREAM_DQ_AUDIT = """
SELECT 'DF_Event' AS target_table, 'events' AS validated_table,
       CASE WHEN event_type = 'error' THEN 'QUARANTINE' ELSE 'WARN' END AS dq_type,
       CAST(ts AS DATE) AS business_date,
       CASE WHEN event_type = 'error' THEN 'event_type = ''error''' ELSE 'value > 100' END AS rules, event_id
FROM events WHERE event_type = 'error' OR value > 100
"""


def stream_scd1(spark: SparkSession, folder: str) -> DataFrame:
    stream, place = _landed(spark, history.changes(spark, folder), "upsert")
    where = (f"{place}-state", f"{place}-latest")
    flows.follow_latest(stream, *where, history.KEYS, "business_date", "processing_time")
    latest = flows.latest_state(spark, where[1], history.KEYS, "business_date", "processing_time")
    return latest.drop("value")


def stream_scd2(spark: SparkSession, folder: str) -> DataFrame:
    stream, place = _landed(spark, history.changes(spark, folder), "versions")
    flows.follow_changes(stream, f"{place}-state", f"{place}-changes")
    versions = flows.history_state(
        spark, f"{place}-changes", history.KEYS, "business_date", "processing_time"
    )
    return present_scd2(versions.drop("Row_Is_Deleted_Ind"), deleted=None)


def stream_scd2_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The same versions, kept up to date bucket by bucket."""
    stream, place = _landed(spark, history.changes(spark, folder), "history")
    flows.follow_history(
        stream,
        f"{place}-state",
        f"{place}-log",
        f"{place}-table",
        history.KEYS,
        "business_date",
        "processing_time",
        lambda versions: present_scd2(versions.drop("Row_Is_Deleted_Ind"), deleted=None),
        buckets=16,
    )
    return flows.read_history(spark, f"{place}-table")


QUERIES = {
    "stream_bronze": (stream_bronze, STREAM_BRONZE),
    "stream_dq_clean": (stream_dq_clean, STREAM_DQ_CLEAN),
    "stream_dq_audit": (stream_dq_audit, STREAM_DQ_AUDIT),
    "stream_scd1": (stream_scd1, history.SCD1_LATEST),
    "stream_scd2": (stream_scd2, history.SCD2_HISTORY),
    "stream_scd2_refresh": (stream_scd2_refresh, history.SCD2_HISTORY),
}
