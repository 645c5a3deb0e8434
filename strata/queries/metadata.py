"""Metadata look-ups, run over configuration derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.ordered import latest_per_key
from strata.plans import config as meta
from strata.queries.tables import day, table


def _scenarios(spark: SparkSession, folder: str) -> DataFrame:
    """One scenario row per segment, priority and nation with its last order date."""
    per_customer = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", "o_orderpriority")
        .agg(F.max(day("o_orderdate")).alias("last_date"))
    )
    named = per_customer.join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    latest = named.groupBy("c_mktsegment", "o_orderpriority", "c_nationkey").agg(
        F.max("last_date").alias("last_date")
    )
    nation = table(spark, folder, "nation")
    return latest.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_mktsegment").alias("dimension_table"),
        F.col("o_orderpriority").alias("scenario_type"),
        F.col("n_name").alias("scenario_input_source_system"),
        F.lit("DF_Order").alias("scenario_input_target_table"),
        F.col("last_date").alias("scenario_input_business_date"),
        F.lit("").alias("scenario_input_source_details"),
        F.lit("parquet").alias("scenario_input_format"),
    )


def run_request(spark: SparkSession, folder: str) -> DataFrame:
    """Scenario rows to run requests, then back to one row per requested source."""
    requests = meta.run_requests(_scenarios(spark, folder), F.lit("2025-04-08").cast("date"))
    return meta.run_inputs(requests)


RUN_REQUEST = """
SELECT c_mktsegment AS dimension_table, DATE '2025-04-08' AS run_date, o_orderpriority AS scenario,
       n_name || '/DF_Order/' || CAST(MAX(CAST(o_orderdate AS DATE)) AS VARCHAR) || '//parquet' AS input,
       CAST(MAX(CAST(o_orderdate AS DATE)) AS VARCHAR) AS business_date,
       n_name AS source_system, 'DF_Order' AS target_table, '' AS source_details, 'parquet' AS file_format
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 3, n_name
"""


def latest_run(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as run requests: the latest per customer, then per market segment."""
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    orders = latest_per_key(table(spark, folder, "orders"), ["o_custkey"], newest).join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    runtime = orders.select(
        F.col("c_mktsegment").alias("dimension_table"),
        day("o_orderdate").alias("run_date"),
        F.col("o_orderpriority").alias("scenario"),
        "o_orderkey",
    )
    return meta.latest_run(runtime, tie=["o_orderkey"])


LATEST_RUN = """
SELECT dimension_table, run_date, scenario, o_orderkey FROM (
  SELECT c_mktsegment AS dimension_table, CAST(o_orderdate AS DATE) AS run_date, o_orderpriority AS scenario,
         o_orderkey, row_number() OVER (PARTITION BY c_mktsegment
            ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
  FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rn = 1
"""


def _part_config(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as source rows: two inputs feeding two targets each."""
    return table(spark, folder, "part").select(
        F.col("p_partkey"),
        F.col("p_brand").alias("source_system"),
        F.lower("p_type").alias("target_table"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("derived_input_tables"),
        F.concat("p_type", F.lit(" , size_"), F.col("p_size").cast("string")).alias(
            "derived_target_tables"
        ),
        F.lit("D_Part").alias("dimension_table"),
        F.when(F.col("p_size") > 25, "historical_run, incremental_run")
        .otherwise("historical_run_old")
        .alias("scenario"),
        F.when(F.col("p_retailprice") > 950, "Y").otherwise("N").alias("is_active"),
        F.lit("N").alias("test_mode"),
    )


def targets_fanout(spark: SparkSession, folder: str) -> DataFrame:
    found = meta.systems_per_target(_part_config(spark, folder))
    return found.select("target_table", F.array_join("source_systems", ",").alias("source_systems"))


TARGETS_FANOUT = """
SELECT target_table, string_agg(p_brand, ',' ORDER BY p_brand) AS source_systems FROM (
  SELECT DISTINCT p_brand, unnest([p_type, 'size_' || CAST(p_size AS VARCHAR)]) AS target_table FROM part)
GROUP BY 1
"""


def targets_of_run(spark: SparkSession, folder: str) -> DataFrame:
    found = meta.targets_of_run(
        _part_config(spark, folder),
        "d_part",
        ["Economy", "SMALL"],
        ["brand#1", "Brand#2", "Brand#3"],
        "historical_run",
    )
    return found.select("target_table", F.array_join("source_systems", ",").alias("source_systems"))


TARGETS_OF_RUN = """
SELECT target_table, string_agg(p_brand, ',' ORDER BY p_brand) AS source_systems FROM (
  SELECT DISTINCT p_brand, unnest([p_type, 'size_' || CAST(p_size AS VARCHAR)]) AS target_table FROM part
  WHERE p_type IN ('ECONOMY', 'SMALL') AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')
    AND p_size > 25 AND p_retailprice > 950)
GROUP BY 1
"""


def paired_tables(spark: SparkSession, folder: str) -> DataFrame:
    rows = meta.paired_tables(_part_config(spark, folder))
    return rows.select("p_partkey", "input_table", "derived_target")


PAIRED = """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS input_table,
       unnest([p_type, 'size_' || CAST(p_size AS VARCHAR)]) AS derived_target FROM part
"""


def rule_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Source rows of one target, system and scenario, in any letter case."""
    rows = meta.source_rows(
        _part_config(spark, folder), "d_part", "ECONOMY", "brand#7", "Incremental_Run", "n"
    )
    return rows.select("p_partkey", "source_system", "target_table", "scenario")


RULE_LOOKUP = """
SELECT p_partkey, p_brand AS source_system, 'economy' AS target_table,
       'historical_run, incremental_run' AS scenario
FROM part WHERE p_type = 'ECONOMY' AND p_brand = 'Brand#7' AND p_size > 25 AND p_retailprice > 950
"""


def flat_views(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as links between suppliers, parts and return scenarios."""
    lines = table(spark, folder, "lineitem")
    parts = table(spark, folder, "part")
    links = lines.select(
        F.col("l_suppkey").alias("source_id"),
        F.col("l_partkey").alias("input_table_id"),
        F.col("l_suppkey").alias("target_table_id"),
        F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")).alias("dimension_table_id"),
        F.col("l_returnflag").alias("scenario_id"),
    )
    sources = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("source_id"),
        F.col("s_name").alias("source_name"),
        F.col("s_nationkey").cast("string").alias("source_system"),
        (F.col("s_acctbal") > 0).alias("is_active"),
    )
    tables = parts.select(F.col("p_partkey").alias("table_id"), F.col("p_type").alias("table_name"))
    scenarios = lines.select(F.col("l_returnflag").alias("scenario_id")).distinct()
    scenarios = scenarios.select(
        "scenario_id",
        F.concat(F.lit("flag_"), "scenario_id").alias("scenario_name"),
        (F.col("scenario_id") == "N").alias("test_mode"),
    )
    return meta.flat_sources(links, sources, tables, scenarios)


FLAT_VIEWS = """
WITH links AS (SELECT DISTINCT l_suppkey, l_partkey, l_returnflag FROM lineitem)
SELECT s_name AS source_name, CAST(s_nationkey AS VARCHAR) AS source_system, d.p_type AS dimension_table,
       'flag_' || l_returnflag AS scenario_name, t.p_type AS target_table,
       string_agg(DISTINCT i.p_type, ',' ORDER BY i.p_type) AS derived_input_tables,
       CASE WHEN l_returnflag = 'N' THEN 'Y' ELSE 'N' END AS test_mode
FROM links JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 0
JOIN part i ON i.p_partkey = l_partkey JOIN part t ON t.p_partkey = l_suppkey
LEFT JOIN part d ON d.p_partkey = CASE WHEN l_returnflag = 'R' THEN l_suppkey END
GROUP BY 1, 2, 3, 4, 5, 7
"""

QUERIES = {
    "meta_run_request": (run_request, RUN_REQUEST),
    "meta_latest_run": (latest_run, LATEST_RUN),
    "meta_targets_fanout": (targets_fanout, TARGETS_FANOUT),
    "meta_targets_of_run": (targets_of_run, TARGETS_OF_RUN),
    "meta_paired_tables": (paired_tables, PAIRED),
    "meta_rule_lookup": (rule_lookup, RULE_LOOKUP),
    "meta_flat_views": (flat_views, FLAT_VIEWS),
}
