"""Landing zone: scans, stamps, appends, reloads and corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans.config import resolve_source
from strata.queries.tables import month, table
from strata.session import new_folder
from strata.sources import landing
from strata.sources.contracts import rescue

CORRECTED_MONTH = "1998-03-01"


def batch_stamp(spark: SparkSession, folder: str) -> DataFrame:
    raw = landing.read_files(spark, f"{folder}/orders.parquet", "parquet")
    rows = landing.stamp(raw, "dbo", date_column="o_orderdate")
    return rows.select(
        "o_orderkey",
        "o_totalprice",
        "source",
        "source_schema",
        F.col("`__$operation`").alias("operation"),
        "business_date",
    )


BATCH_STAMP = """
SELECT o_orderkey, o_totalprice, 'Not Used' AS source, 'dbo' AS source_schema, '5' AS operation,
       CAST(o_orderdate AS DATE) AS business_date
FROM orders
"""


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").withColumn("delivered", month("o_orderdate"))
    return landing.stamp(rows, "dbo", date_column="delivered").drop("delivered")


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select("o_orderkey", "o_totalprice", "o_orderpriority", "business_date")


def append_evolve(spark: SparkSession, folder: str) -> DataFrame:
    rows, place = _monthly(spark, folder), new_folder(spark, "append")
    early = F.col("business_date") < "1998-01-01"
    landing.append(rows.filter(early).drop("o_orderpriority"), place)
    landing.append(rows.filter(~early), place)
    return _shown(landing.read_table(spark, place))


APPEND_EVOLVE = """
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS business_date
FROM orders
"""


def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    rows, place = _monthly(spark, folder), new_folder(spark, "refresh")
    landing.append(rows, place)
    landing.overwrite(rows.withColumn("o_totalprice", F.round(F.col("o_totalprice") + 1, 2)), place)
    return _shown(landing.read_table(spark, place))


FULL_REFRESH = """
SELECT o_orderkey, ROUND(o_totalprice + 1, 2) AS o_totalprice, o_orderpriority,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS business_date
FROM orders
"""


def replace_business_date(spark: SparkSession, folder: str) -> DataFrame:
    rows, place = _monthly(spark, folder), new_folder(spark, "replace")
    landing.append(rows, place)
    reloaded = rows.filter(F.col("business_date") == CORRECTED_MONTH)
    landing.replace_dates(
        reloaded.withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2)), place
    )
    return _shown(landing.read_table(spark, place))


REPLACE_BUSINESS_DATE = f"""
SELECT o_orderkey,
       CASE WHEN date_trunc('month', o_orderdate) = DATE '{CORRECTED_MONTH}'
            THEN ROUND(o_totalprice * 2, 2) ELSE o_totalprice END AS o_totalprice,
       o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS business_date
FROM orders
"""


def row_correction(spark: SparkSession, folder: str) -> DataFrame:
    rows, place = _monthly(spark, folder), new_folder(spark, "correct")
    landing.append(rows, place)
    wrong = (F.col("business_date") == CORRECTED_MONTH) & (F.col("o_orderstatus") == "P")
    fixed = rows.filter(wrong).withColumn("o_totalprice", F.round(F.col("o_totalprice") + 100, 2))
    landing.correct_rows(spark, place, fixed, ["o_orderkey"])
    return _shown(landing.read_table(spark, place))


ROW_CORRECTION = f"""
SELECT o_orderkey,
       CASE WHEN date_trunc('month', o_orderdate) = DATE '{CORRECTED_MONTH}' AND o_orderstatus = 'P'
            THEN ROUND(o_totalprice + 100, 2) ELSE o_totalprice END AS o_totalprice,
       o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS business_date
FROM orders
"""


def partition_scan(spark: SparkSession, folder: str) -> DataFrame:
    place = new_folder(spark, "dated")
    rows = table(spark, folder, "events")
    named = rows.withColumn("BusinessStartDate", F.date_format("ts", "yyyyMMdd"))
    spread = named.hint("rebalance", F.col("BusinessStartDate"))
    spread.write.partitionBy("BusinessStartDate").parquet(place)
    found = landing.read_dates(spark, place, "20240108", "20240114")
    return found.groupBy("BusinessStartDate", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


PARTITION_SCAN = """
SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS "BusinessStartDate", event_type,
       COUNT(*) AS n, ROUND(SUM(value), 2) AS total
FROM events
WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'
GROUP BY 1, 2
"""


def path_template_override(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a load request with a stored path template."""
    status = F.col("o_orderstatus")
    requests = table(spark, folder, "orders").withColumns(
        {
            "source_details": F.concat(
                F.lit("/raw/"), "o_orderpriority", F.lit("/BusinessStartDate={}/orders/")
            ),
            "file_format": F.lit("parquet"),
        }
    )
    resolved = resolve_source(
        requests,
        F.col("o_orderdate"),
        incremental=status != "F",
        override_path=F.when(status == "P", "/corrected/orders/").when(status == "O", ""),
        override_format=F.when(status == "P", "csv"),
    )
    return resolved.select("o_orderkey", "source_details", "file_format")


PATH_TEMPLATE_OVERRIDE = """
SELECT o_orderkey,
       CASE o_orderstatus
            WHEN 'P' THEN '/corrected/orders/'
            WHEN 'O' THEN '/raw/' || o_orderpriority || '/BusinessStartDate='
                          || strftime(o_orderdate, '%Y%m%d') || '/orders/'
            ELSE '/raw/' || o_orderpriority || '/BusinessStartDate={}/orders/' END AS source_details,
       CASE o_orderstatus WHEN 'P' THEN 'csv' ELSE 'parquet' END AS file_format
FROM orders
"""

EVENT_CONTRACT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)


def contract_rescue(spark: SparkSession, folder: str) -> DataFrame:
    return rescue(table(spark, folder, "events").drop("ts"), EVENT_CONTRACT)


CONTRACT_RESCUE = """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(NULL AS VARCHAR) AS region,
       CAST(to_json(struct_pack(value := value, props := props)) AS VARCHAR) AS rescued_data
FROM events
"""

QUERIES = {
    "landing_batch_stamp": (batch_stamp, BATCH_STAMP),
    "landing_append_evolve": (append_evolve, APPEND_EVOLVE),
    "landing_full_refresh": (full_refresh, FULL_REFRESH),
    "landing_replace_business_date": (replace_business_date, REPLACE_BUSINESS_DATE),
    "landing_row_correction": (row_correction, ROW_CORRECTION),
    "landing_partition_scan": (partition_scan, PARTITION_SCAN),
    "path_template_override": (path_template_override, PATH_TEMPLATE_OVERRIDE),
    "schema_contract_drift": (contract_rescue, CONTRACT_RESCUE),
}
