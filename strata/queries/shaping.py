"""Bronze typing, rule-driven transforms and source to target mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.bronze import to_bronze
from strata.operators.mapping import (
    choose_mapping,
    map_entity,
    rename_existing,
    union_sources,
)
from strata.operators.transform import TransformRule, apply_transforms, with_defaults
from strata.plans import group_dimension as dim
from strata.queries.tables import day, table

RUN = 1744070400


def bronze_contract(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("Group ID"),
        F.col("c_name").alias("Group Name"),
        F.col("c_nationkey").alias("Group Type Code"),
        F.col("c_acctbal").alias("Not In Contract"),
        F.lit(202504081230).alias("loadtimestamp"),
        F.lit("20250408").alias("business_date"),
    )
    required = ["Group ID", "Group Name", "Group Type Code", "loadtimestamp", "business_date"]
    typed = to_bronze(raw, required, RUN, additional_columns={"Group Type Code": "string"})
    return typed.withColumn("loadtimestamp", F.date_format("loadtimestamp", "yyyy-MM-dd HH:mm:ss"))


BRONZE_CONTRACT = f"""
SELECT c_custkey AS "Group_ID", c_name AS "Group_Name", CAST(c_nationkey AS VARCHAR) AS "Group_Type_Code",
       '2025-04-08 12:30:00' AS loadtimestamp, DATE '2025-04-08' AS business_date,
       CAST({RUN} AS BIGINT) AS processing_time
FROM customer
"""


def bronze_parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    raw = table(spark, folder, "events").select(
        "event_id",
        F.date_format("ts", "yyyyMMddHHmm").alias("loadtimestamp"),
        F.when(kind == "click", F.date_format("ts", "yyyyMMdd"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "error", "2025-13-99")
        .when(kind == "signup", "")
        .alias("business_date"),
    )
    typed = to_bronze(raw, raw.columns, RUN)
    return typed.withColumn("loadtimestamp", F.date_format("loadtimestamp", "yyyy-MM-dd HH:mm:ss"))


BRONZE_PARSE_DATES = f"""
SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS loadtimestamp,
       CASE WHEN event_type IN ('click', 'view') THEN CAST(ts AS DATE) END AS business_date,
       CAST({RUN} AS BIGINT) AS processing_time
FROM events
"""


def sql_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules on one column chain in order: pad, trim, then initial capitals."""
    rules = [
        TransformRule("p_name", "expression", "concat('  ', p_name, ' ')"),
        TransformRule("p_name", "title case", "initcap", order=9),
        TransformRule("p_name", "trim", "trim", order=8),
        TransformRule("p_type", "lower", "lower"),
        TransformRule("p_brand", "upper", "upper"),
        TransformRule("label", "expression", "concat(p_name, '/', p_type)", order=10),
    ]
    return apply_transforms(table(spark, folder, "part"), rules).select(
        "p_partkey", "p_name", "p_type", "p_brand", "label"
    )


_CAPITALS = """list_aggregate(list_transform(string_split(p_name, ' '),
    lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), 'string_agg', ' ')"""
SQL_RULES = f"""
SELECT p_partkey, {_CAPITALS} AS p_name, lower(p_type) AS p_type, upper(p_brand) AS p_brand,
       {_CAPITALS} || '/' || lower(p_type) AS label
FROM part
"""


def default_custom(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        TransformRule("origin", "default", "warehouse"),
        TransformRule("p_name", "custom", "title_case_udf"),
        TransformRule("p_type", "custom", "sample_udf"),
        TransformRule("p_brand", "custom", "trim_udf"),
    ]
    parts = table(spark, folder, "part").withColumns(
        {
            "p_name": F.replace("p_name", F.lit(" "), F.lit("-")),
            "p_brand": F.concat(F.lit("\t "), "p_brand", F.lit(" \n")),
        }
    )
    changed = apply_transforms(parts, rules)
    changed = with_defaults(changed, ["currency", "unit"], ["USD", "EA"])
    return changed.select("p_partkey", "origin", "p_name", "p_type", "p_brand", "currency", "unit")


DEFAULT_CUSTOM = """
SELECT p_partkey, 'warehouse' AS origin,
       list_aggregate(list_transform(string_split(p_name, ' '),
           lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), 'string_agg', '-') AS p_name,
       'sample' AS p_type, p_brand, 'USD' AS currency, 'EA' AS unit
FROM part
"""


def a_group(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in the shape of the first system's entity feed."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("GRGR_CK"),
        F.col("c_name").alias("GRGR_ID"),
        F.col("c_name").alias("GRGR_NAME"),
        F.col("c_mktsegment").alias("GRGR_MCTR_TYPE"),
        F.col("c_nationkey").cast("string").alias("GRGR_ITS_CODE"),
        F.lit("2001-01-01").cast("timestamp_ntz").alias("GRGR_ORIG_EFF_DT"),
        F.lit("2002-01-01").cast("timestamp_ntz").alias("GRGR_CONV_DT"),
        F.lit("2025-04-08").cast("date").alias("business_date"),
        F.lit(RUN).cast("long").alias("processing_time"),
        F.when(F.col("c_acctbal") < 0, "1").otherwise("5").alias("__$operation"),
        F.lit("Not Used").alias("source"),
        F.lit("cdc").alias("source_schema"),
    )


def a_history(spark: SparkSession, folder: str) -> DataFrame:
    """Order states in the shape of the first system's history feed."""
    unused = {c: F.lit("") for c in dim.A_HISTORY_COLUMNS}
    made = {
        **unused,
        "GRGR_CK": F.col("o_custkey"),
        "GRGR_ID": F.concat(F.lit("G"), F.col("o_custkey").cast("string")),
        "GRGR_STS": F.col("o_orderstatus"),
        "GRGR_CITY": F.col("o_orderpriority"),
        "GRGR_COUNTY": F.lit("county"),
        "GRGR_CTRY_CD": F.lit("US"),
        "GRGR_TERM_DT": F.lit("9999-12-31").cast("timestamp_ntz"),
        "GRGR_RNST_DT": F.lit("9999-12-31").cast("timestamp_ntz"),
        "GRGR_RENEW_MMDD": F.lit(101).cast("smallint"),
        "GRGR_ERIS_MMDD": F.lit(701).cast("smallint"),
    }
    return table(spark, folder, "orders").select(
        *[made[c].alias(c) for c in dim.A_HISTORY_COLUMNS],
        day("o_orderdate").alias("business_date"),
        F.col("o_orderkey").alias("processing_time"),
        F.lit("5").alias("__$operation"),
    )


def a_count(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per customer, priority band and year in the shape of the count feed."""
    start = F.trunc(day("o_orderdate"), "year")
    band = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "MLRR")
        .when(F.col("o_orderpriority") == "2-HIGH", "MLRP")
        .otherwise("MLRD")
    )
    counted = table(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("GRGR_CK"), band.alias("GRGC_MCTR_CTYP"), start.alias("GRGC_EFF_DT")
    )
    return counted.agg(F.count(F.lit(1)).cast("int").alias("GRGC_COUNT")).select(
        "GRGR_CK",
        "GRGC_MCTR_CTYP",
        "GRGC_EFF_DT",
        F.add_months("GRGC_EFF_DT", 12).alias("GRGC_TERM_DT"),
        "GRGC_COUNT",
        F.col("GRGC_EFF_DT").alias("business_date"),
        F.lit(RUN).cast("long").alias("processing_time"),
        F.lit("5").alias("__$operation"),
    )


def b_history(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers in the shape of the second system's flat file, after header cleaning."""
    balance = F.col("s_acctbal")
    made = {
        "Group_ID": F.col("s_name"),
        "Group_Termination_Date": F.when(balance < 0, "20781231")
        .when(balance > 9000, F.lit(None))
        .otherwise("20250630"),
        "Group_Address_City": F.col("s_nationkey").cast("string"),
        "Group_Renewal_Month": F.lit(7),
    }
    names = [c.replace(" ", "_") for c in dim.B_HISTORY_COLUMNS]
    return table(spark, folder, "supplier").select(
        *[made.get(c, F.lit("x")).alias(c) for c in names],
        F.lit("2025-04-08").cast("date").alias("business_date"),
        F.lit(RUN).cast("long").alias("processing_time"),
        F.when(balance < 0, "D").otherwise("I").alias("Operation_Code"),
    )


def b_group(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_name").alias("Group_ID"),
        F.col("s_name").alias("Group_Name"),
        F.col("s_nationkey").cast("string").alias("Group_Type_Code"),
        F.when(F.col("s_acctbal") < 0, "not a date").otherwise("20010101").alias(
            "Group_Original_Effective_Date"
        ),
        F.lit("2025-04-08").cast("date").alias("business_date"),
        F.lit(RUN).cast("long").alias("processing_time"),
        F.when(F.col("s_acctbal") < 0, "D").otherwise("I").alias("Operation_Code"),
    )


def mapped(rows: DataFrame, system: str, target: str) -> DataFrame:
    return map_entity(rows, choose_mapping(dim.mappings(), system, target))


def _plain(rows: DataFrame) -> DataFrame:
    return rows.drop("Row_Change_Datetime")


def map_source_a(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(mapped(a_group(spark, folder), "facets", "DF_GROUP"))


MAP_SOURCE_A = f"""
SELECT c_name AS "Group_Id", c_name AS "Group_Name", c_mktsegment AS "Group_Type_Code",
       CAST(c_nationkey AS VARCHAR) AS "ITS_Code", DATE '2025-04-08' AS business_date,
       CAST({RUN} AS BIGINT) AS processing_time, CAST(c_custkey AS VARCHAR) AS "Group_Source_Key",
       'Facets' AS "Source_System_Code", CASE WHEN c_acctbal < 0 THEN 'Y' ELSE 'N' END AS "Row_Is_Deleted_Ind",
       DATE '2001-01-01' AS "Original_Effective_Date", DATE '2002-01-01' AS "Group_Facets_Conversion_Date"
FROM customer
"""


def map_history_a(spark: SparkSession, folder: str) -> DataFrame:
    rows = mapped(a_history(spark, folder), "Facets", "DF_Group_History")
    return rows.select(
        "Group_Source_Key", "Source_System_Code", "Status_Code", "Address_City", "Address_County",
        "Country", "Termination_Date", "Reinstatement_Date", "Renewal_MMDD", "ERISA_Plan_Begin_MMDD",
        "EIN", "business_date", "processing_time", "Row_Is_Deleted_Ind",
    )


MAP_HISTORY_A = """
SELECT CAST(o_custkey AS VARCHAR) AS "Group_Source_Key", 'Facets' AS "Source_System_Code",
       o_orderstatus AS "Status_Code", o_orderpriority AS "Address_City", 'county' AS "Address_County",
       'US' AS "Country", DATE '9999-12-31' AS "Termination_Date", DATE '9999-12-31' AS "Reinstatement_Date",
       '101' AS "Renewal_MMDD", '701' AS "ERISA_Plan_Begin_MMDD", '' AS "EIN",
       CAST(o_orderdate AS DATE) AS business_date, o_orderkey AS processing_time, 'N' AS "Row_Is_Deleted_Ind"
FROM orders
"""


def map_count_a(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(mapped(a_count(spark, folder), "Facets", "DF_Group_Count"))


COUNT_FEED = """
SELECT o_custkey AS k,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'MLRR' WHEN '2-HIGH' THEN 'MLRP' ELSE 'MLRD' END AS kind,
       CAST(date_trunc('year', o_orderdate) AS DATE) AS eff,
       CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR AS DATE) AS term,
       CAST(COUNT(*) AS INTEGER) AS n
FROM orders GROUP BY 1, 2, 3, 4
"""
MAP_COUNT_A = f"""
SELECT kind AS "Count_Type", eff AS "Row_Effective_Date", term AS "Row_Term_Date", n AS "Employee_Count",
       eff AS business_date, CAST({RUN} AS BIGINT) AS processing_time,
       CAST(k AS VARCHAR) AS "Group_Source_Key", 'Facets' AS "Source_System_Code", 'N' AS "Row_Is_Deleted_Ind"
FROM ({COUNT_FEED})
"""


def map_source_b(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(mapped(b_group(spark, folder), "vhp", "df_group"))


B_GROUP_SQL = f"""
SELECT s_name AS "Group_Name", CAST(s_nationkey AS VARCHAR) AS "Group_Type_Code",
       DATE '2025-04-08' AS business_date, CAST({RUN} AS BIGINT) AS processing_time,
       s_name AS "Group_Source_Key", 'VHP' AS "Source_System_Code",
       CASE WHEN s_acctbal < 0 THEN 'Y' ELSE 'N' END AS "Row_Is_Deleted_Ind", s_name AS "Group_Id",
       '' AS "ITS_Code", CASE WHEN s_acctbal < 0 THEN NULL ELSE DATE '2001-01-01' END AS "Original_Effective_Date",
       DATE '9999-12-31' AS "Group_Facets_Conversion_Date"
FROM supplier
"""


def map_history_b(spark: SparkSession, folder: str) -> DataFrame:
    rows = mapped(b_history(spark, folder), "VHP", "DF_Group_History")
    return rows.select(
        "Group_Source_Key", "Source_System_Code", "Status_Code", "Address_City", "Address_County",
        "Country", "Termination_Date", "Reinstatement_Date", "Renewal_MMDD", "ERISA_Plan_Begin_MMDD",
        "EIN", "business_date", "processing_time", "Row_Is_Deleted_Ind",
    )


MAP_HISTORY_B = f"""
SELECT s_name AS "Group_Source_Key", 'VHP' AS "Source_System_Code", '' AS "Status_Code",
       CAST(s_nationkey AS VARCHAR) AS "Address_City", '' AS "Address_County", 'x' AS "Country",
       CASE WHEN s_acctbal < 0 THEN DATE '9999-12-31' WHEN s_acctbal > 9000 THEN NULL
            ELSE DATE '2025-06-30' END AS "Termination_Date",
       DATE '9999-12-31' AS "Reinstatement_Date", '7' AS "Renewal_MMDD", '0000' AS "ERISA_Plan_Begin_MMDD",
       'x' AS "EIN", DATE '2025-04-08' AS business_date, CAST({RUN} AS BIGINT) AS processing_time,
       CASE WHEN s_acctbal < 0 THEN 'Y' ELSE 'N' END AS "Row_Is_Deleted_Ind"
FROM supplier
"""


def map_union_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Both systems in one entity; the second lacks the ITS code column."""
    a = map_source_a(spark, folder)
    b = map_source_b(spark, folder).drop("ITS_Code")
    return union_sources([a, b]).withColumn("ITS_Code", F.coalesce("ITS_Code", F.lit("none")))


MAP_UNION_SOURCES = f"""
SELECT * REPLACE (coalesce("ITS_Code", 'none') AS "ITS_Code") FROM (
  SELECT * FROM ({MAP_SOURCE_A})
  UNION ALL BY NAME
  SELECT * EXCLUDE ("ITS_Code") FROM ({B_GROUP_SQL}))
"""


def rename_and_filter(spark: SparkSession, folder: str) -> DataFrame:
    names = {"s_suppkey": "party_key", "s_name": "party_name", "s_phone": "phone", "s_acctbal": "balance"}
    return rename_existing(table(spark, folder, "supplier"), names, "balance >= 0")


RENAME_AND_FILTER = """
SELECT s_suppkey AS party_key, s_name AS party_name, s_acctbal AS balance FROM supplier WHERE s_acctbal >= 0
"""

QUERIES = {
    "bronze_contract": (bronze_contract, BRONZE_CONTRACT),
    "bronze_parse_dates": (bronze_parse_dates, BRONZE_PARSE_DATES),
    "transform_sql_rules": (sql_rules, SQL_RULES),
    "transform_default_custom": (default_custom, DEFAULT_CUSTOM),
    "map_source_a": (map_source_a, MAP_SOURCE_A),
    "map_history_a": (map_history_a, MAP_HISTORY_A),
    "map_count_a": (map_count_a, MAP_COUNT_A),
    "map_source_b": (map_source_b, B_GROUP_SQL),
    "map_history_b": (map_history_b, MAP_HISTORY_B),
    "map_union_sources": (map_union_sources, MAP_UNION_SOURCES),
    "map_rename_existing": (rename_and_filter, RENAME_AND_FILTER),
}
