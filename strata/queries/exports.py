"""Text exports and their way back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.queries.tables import table
from strata.session import new_folder
from strata.sources import extract

HEADER = ["NATION", "1", "20250101", "20251231"]
CLIENT = ["Test Client", "0001"]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as parents, their customers as children, their region as cover."""
    nation = table(spark, folder, "nation").withColumn("nation", F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
    customer = table(spark, folder, "customer").withColumn(
        "nation", F.lpad(F.col("c_nationkey").cast("string"), 3, "0")
    )
    region = table(spark, folder, "region")
    covers = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return extract.tagged_lines(
        nation,
        customer,
        covers,
        "nation",
        "c_custkey",
        CLIENT,
        HEADER,
        {
            extract.PARENT: ["nation", "n_name"],
            extract.CHILD: ["nation", "c_custkey", "c_name", "c_mktsegment"],
            extract.COVER: ["r_regionkey", "r_name"],
        },
    )


def hierarchical(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder).select("section", "parent", "level", "position", "line")


_P = "lpad(CAST(n_nationkey AS VARCHAR), 3, '0')"
_C = "lpad(CAST(c_nationkey AS VARCHAR), 3, '0')"
HIERARCHICAL = f"""
WITH body AS (
  SELECT 2 AS section, {_P} AS parent, 0 AS level, CAST(0 AS BIGINT) AS position,
         'CTR|' || {_P} || '|' || n_name AS line FROM nation
  UNION ALL SELECT 2, {_C}, 1, c_custkey,
         'SBP|' || {_C} || '|' || c_custkey || '|' || c_name || '|' || c_mktsegment FROM customer
  UNION ALL SELECT 2, {_P}, 2, 0, 'COM|' || r_regionkey || '|' || r_name
         FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT * FROM body
UNION ALL SELECT 0, '', 0, 0, 'HDR|NATION|1|20250101|20251231'
UNION ALL SELECT 1, '', 0, 0, 'CLI|Test Client|0001'
UNION ALL SELECT 3, '', 0, 0, 'FTR|NATION|1|20250101|20251231'
UNION ALL SELECT 4, '', 0, 0, 'CNT|1|' || (SELECT COUNT(*) FROM nation) || '|' || (SELECT COUNT(*) FROM customer)
   || '|' || (SELECT COUNT(*) FROM nation JOIN region ON n_regionkey = r_regionkey)
   || '|' || (SELECT COUNT(*) + 1 FROM body)
"""


def _written(spark: SparkSession, folder: str) -> DataFrame:
    place = new_folder(spark, "extract")
    extract.write_lines(_lines(spark, folder), place)
    return extract.read_lines(spark, place)


def parse(spark: SparkSession, folder: str) -> DataFrame:
    """Child and cover lines of the written file with the parent they stand under."""
    lines = _written(spark, folder).filter(F.col("tag").isin(extract.CHILD, extract.COVER))
    return lines.select("tag", "parent", F.array_join("fields", "|").alias("fields"))


PARSE = f"""
SELECT 'SBP' AS tag, {_C} AS parent, {_C} || '|' || c_custkey || '|' || c_name || '|' || c_mktsegment AS fields
FROM customer
UNION ALL
SELECT 'COM', {_P}, r_regionkey || '|' || r_name FROM nation JOIN region ON n_regionkey = r_regionkey
"""


def reconcile(spark: SparkSession, folder: str) -> DataFrame:
    return extract.reconcile(_written(spark, folder))


RECONCILE = """
WITH n AS (SELECT 'CLI' AS tag, 1 AS counted UNION ALL SELECT 'CTR', COUNT(*) FROM nation
  UNION ALL SELECT 'SBP', COUNT(*) FROM customer
  UNION ALL SELECT 'COM', COUNT(*) FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT tag, CAST(counted AS BIGINT) AS counted, CAST(counted AS BIGINT) AS stated, TRUE AS matches FROM n
UNION ALL SELECT 'TOTAL', CAST(SUM(counted) AS BIGINT), CAST(SUM(counted) AS BIGINT), TRUE FROM n
"""


def sql_literals(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer as an INSERT statement."""
    rows = table(spark, folder, "customer").select(
        "c_custkey",
        F.replace("c_name", F.lit("#"), F.lit("'")).alias("c_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        (F.col("c_acctbal") > 5000).alias("is_large"),
    )
    return extract.insert_statements(rows, "customer_copy")


SQL_LITERALS = """
SELECT 'INSERT INTO customer_copy (`c_custkey`, `c_name`, `c_acctbal`, `is_large`) VALUES (' || c_custkey || ', '''
       || replace(c_name, '#', '''''') || ''', '
       || CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS VARCHAR) ELSE 'NULL' END || ', '
       || CASE WHEN c_acctbal > 5000 THEN 'TRUE' ELSE 'FALSE' END || ');' AS value
FROM customer
"""

QUERIES = {
    "extract_hierarchical": (hierarchical, HIERARCHICAL),
    "extract_parse": (parse, PARSE),
    "extract_reconcile": (reconcile, RECONCILE),
    "export_sql_literals": (sql_literals, SQL_LITERALS),
}
