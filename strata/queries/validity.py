"""Validity timelines: the gold build and its steps."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.labels import label
from strata.operators.scd import present_scd2, scd1, scd2
from strata.operators.temporal import Intervals, align, islands, slices, timeline, trim
from strata.plans import group_dimension as dim
from strata.queries import shaping
from strata.queries.tables import day, table
from strata.session import save_and_read

K = ["k"]
ATTRIBUTES = ["group_name", "type_code", "status", "n", "yr"]


def entities(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("k"),
        F.col("c_name").alias("group_name"),
        F.col("c_mktsegment").alias("type_code"),
    )


def states(spark: SparkSession, folder: str) -> Intervals:
    """Order status of a customer as type 2 history."""
    changes = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("k"),
        day("o_orderdate").alias("eff"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderstatus").alias("status"),
    )
    versions = scd2(changes, K, "eff", "seq", unique=True)
    end = F.coalesce("end_at", F.lit("9999-12-31").cast("date"))
    return Intervals(versions.select("k", "status", "eff", end.alias("term")), K, "eff", "term")


def counts(spark: SparkSession, folder: str) -> Intervals:
    """Orders of a customer per calendar year."""
    start = F.trunc(day("o_orderdate"), "year")
    counted = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("k"), start.alias("eff"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return Intervals(counted.withColumn("term", F.add_months("eff", 12)), K, "eff", "term", "n <> 0")


HIST = """
grp AS (SELECT c_custkey AS k, c_name AS group_name, c_mktsegment AS type_code FROM customer),
hist AS (SELECT k, eff, coalesce(lead(eff) OVER w, DATE '9999-12-31') AS term, status
  FROM (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS eff, o_orderkey AS seq, o_orderstatus AS status FROM orders)
  WINDOW w AS (PARTITION BY k ORDER BY eff, seq)),
cnt AS (SELECT o_custkey AS k, CAST(date_trunc('year', o_orderdate) AS DATE) AS eff,
               CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR AS DATE) AS term, COUNT(*) AS n
        FROM orders GROUP BY 1, 2, 3)
"""
SLICES = """
pts AS (SELECT k, eff AS d FROM hist UNION SELECT k, term FROM hist
        UNION SELECT k, eff FROM cnt WHERE n <> 0 UNION SELECT k, term FROM cnt WHERE n <> 0),
slices AS (SELECT * FROM (SELECT k, d AS s, lead(d) OVER (PARTITION BY k ORDER BY d) AS e FROM pts) t
           WHERE e IS NOT NULL)
"""
JOINED = """
inc AS (SELECT DISTINCT g.k, g.group_name, g.type_code, h.status, c.n, year(sl.s) AS yr, sl.s, sl.e
        FROM slices sl JOIN grp g ON g.k = sl.k
        JOIN hist h ON h.k = sl.k AND sl.s >= h.eff AND sl.e <= h.term
        JOIN cnt c ON c.k = sl.k AND sl.s >= c.eff AND sl.e <= c.term AND c.n <> 0)
"""


def _merged(touch: str, per: str) -> str:
    return f"""
flag AS (SELECT *, CASE WHEN p IS NULL OR s > {touch} THEN 1 ELSE 0 END AS isnew FROM (
          SELECT *, lag(e) OVER (PARTITION BY k, group_name, type_code, status, n, yr ORDER BY s) AS p FROM inc) t),
isl AS (SELECT *, SUM(isnew) OVER (PARTITION BY {per} ORDER BY s ROWS UNBOUNDED PRECEDING) AS g FROM flag),
mrg AS (SELECT k, group_name, type_code, status, n, yr, g, MIN(s) AS s, MAX(e) AS e FROM isl GROUP BY ALL)
"""


STATE_ISLANDS = _merged("p", "k, group_name, type_code, status, n, yr")
REFERENCE_ISLANDS = _merged("p + 1", "k")
TRIMMED = """
trm AS (SELECT *, CASE WHEN nx IS NOT NULL AND e >= nx THEN nx - 1 ELSE e END AS e2 FROM (
          SELECT *, lead(s) OVER (PARTITION BY k ORDER BY s) AS nx FROM mrg) t)
"""


def timeline_slices(spark: SparkSession, folder: str) -> DataFrame:
    return slices([states(spark, folder), counts(spark, folder)], "s", "e")


TIMELINE_SLICES = f"WITH {HIST}, {SLICES} SELECT k, s, e FROM slices"


def _published(versions: Intervals, name: str) -> Intervals:
    """The same versions as a written silver table, which later steps read several times."""
    return replace(versions, frame=save_and_read(versions.frame, name))


def containment_join(spark: SparkSession, folder: str) -> DataFrame:
    """Slices joined to every version that contains them, by key and year."""
    hist = _published(states(spark, folder), "states")
    count = _published(counts(spark, folder), "counts")
    rows = slices([hist, count], "s", "e").join(entities(spark, folder), K)
    rows = align(rows, [(hist, ["status"]), (count, ["n"])], "s", "e")
    return rows.withColumn("yr", F.year("s")).distinct()


CONTAINMENT = f"""
WITH {HIST}, {SLICES}, {JOINED} SELECT k, group_name, type_code, status, n, CAST(yr AS INTEGER) AS yr, s, e FROM inc
"""


def swept(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows in one pass: neither history overlaps within a customer."""
    rows = timeline(
        [(states(spark, folder), ["status"]), (counts(spark, folder), ["n"])], "s", "e"
    )
    return rows.join(entities(spark, folder), K).withColumn("yr", F.year("s"))


def open_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Every slice, with the yearly count where there is one (left variant)."""
    hist, count = states(spark, folder), _published(counts(spark, folder), "counts")
    return align(slices([hist, count], "s", "e"), [(count, ["n"])], "s", "e", outer=True)


OPEN_SLICES = f"""
WITH {HIST}, {SLICES}
SELECT sl.k, sl.s, sl.e, c.n FROM slices sl
LEFT JOIN cnt c ON c.k = sl.k AND sl.s >= c.eff AND sl.e <= c.term
"""


def islands_collapse(spark: SparkSession, folder: str) -> DataFrame:
    return islands(swept(spark, folder), K, ATTRIBUTES, "s", "e")


def islands_reference(spark: SparkSession, folder: str) -> DataFrame:
    return islands(swept(spark, folder), K, ATTRIBUTES, "s", "e", mode="reference")


_ISLAND_COLUMNS = "k, group_name, type_code, status, n, CAST(yr AS INTEGER) AS yr, s, e"
ISLANDS = f"WITH {HIST}, {SLICES}, {JOINED}, {STATE_ISLANDS} SELECT {_ISLAND_COLUMNS} FROM mrg"
ISLANDS_REFERENCE = f"""
WITH {HIST}, {SLICES}, {JOINED}, {REFERENCE_ISLANDS} SELECT {_ISLAND_COLUMNS} FROM mrg
"""


def gold_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Closed-day history of (order status, orders in the year) of every customer."""
    merged = islands_collapse(spark, folder)
    closed = trim(merged, K, "s", "e")
    return closed.withColumnsRenamed({"s": "eff", "e": "term"})


GOLD = f"""
WITH {HIST}, {SLICES}, {JOINED}, {REFERENCE_ISLANDS}, {TRIMMED}
SELECT k, group_name, type_code, status, n, CAST(yr AS INTEGER) AS yr, s AS eff, e2 AS term FROM trm WHERE s <= e2
"""


def interval_trim_parallel(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly counts per priority are parallel timelines of one customer."""
    start = F.trunc(day("o_orderdate"), "year")
    counted = table(spark, folder, "orders").groupBy(
        F.col("o_custkey").alias("k"), "o_orderpriority", start.alias("eff")
    )
    rows = counted.agg(F.count(F.lit(1)).alias("n")).withColumn("term", F.add_months("eff", 12))
    return trim(rows, K, "eff", "term", parallel=["o_orderpriority"])


TRIM_PARALLEL = """
SELECT k, o_orderpriority, eff, CASE WHEN nx IS NOT NULL AND term >= nx THEN nx - 1 ELSE term END AS term, n
FROM (SELECT *, lead(eff) OVER (PARTITION BY k, o_orderpriority ORDER BY eff) AS nx FROM (
  SELECT o_custkey AS k, o_orderpriority, CAST(date_trunc('year', o_orderdate) AS DATE) AS eff,
         CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR AS DATE) AS term, COUNT(*) AS n
  FROM orders GROUP BY 1, 2, 3, 4))
"""

# labels of three of the five priorities; the others have none
PRIORITY_LABELS = {"1-URGENT": "Now", "2-HIGH": "Today", "3-MEDIUM": "This week"}


def gold_code_labels(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.select(
        "o_orderkey", label(F.col("o_orderpriority"), PRIORITY_LABELS).alias("priority_label")
    )


CODE_LABELS = """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Now' WHEN '2-HIGH' THEN 'Today'
       WHEN '3-MEDIUM' THEN 'This week' ELSE 'Not Applicable' END AS priority_label
FROM orders
"""


def gold_group(spark: SparkSession, folder: str) -> DataFrame:
    """The whole group dimension: feeds mapped, type 1 and 2 applied, gold built."""
    system, key = dim.SYSTEM_A, ["Group_Source_Key", "Source_System_Code"]
    group = scd1(
        shaping.mapped(shaping.a_group(spark, folder), system, dim.GROUP), key, "business_date"
    )
    states_of_group = shaping.mapped(shaping.a_history(spark, folder), system, dim.HISTORY)
    # the processing time is an order number and unique
    history = present_scd2(scd2(states_of_group, key, "business_date", unique=True))
    count = scd1(
        shaping.mapped(shaping.a_count(spark, folder), system, dim.COUNT),
        [*key, "Count_Type", "Row_Effective_Date"],
        "business_date",
    )
    # gold reads the published silver tables, as a run does
    history = save_and_read(history, "history")
    count = save_and_read(count, "count")
    rows = dim.gold(group, history, count, size=history.count() + count.count())
    return rows.select(
        "Group_Source_Key", "Source_System_Code", "Row_Effective_Date", "Row_Term_Date", "Group_Name",
        "Group_Type_Code", "Status_Code", "Address_City", "Country", "Renewal_MMDD", "Employee_Count",
        "Count_as_of_Year", "Count_Type",
    )


GOLD_GROUP = f"""
WITH hist AS (SELECT k, eff, coalesce(lead(eff) OVER w, DATE '9999-12-31') AS term, status, city
  FROM (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS eff, o_orderkey AS seq,
               o_orderstatus AS status, o_orderpriority AS city FROM orders)
  WINDOW w AS (PARTITION BY k ORDER BY eff, seq)),
cnt AS ({shaping.COUNT_FEED}), {SLICES},
inc AS (SELECT DISTINCT g.c_custkey AS k, g.c_name AS group_name, g.c_mktsegment AS type_code, h.status, h.city,
               c.n, c.kind, year(sl.s) AS yr, sl.s, sl.e
        FROM slices sl JOIN customer g ON g.c_custkey = sl.k
        JOIN hist h ON h.k = sl.k AND sl.s >= h.eff AND sl.e <= h.term
        JOIN cnt c ON c.k = sl.k AND sl.s >= c.eff AND sl.e <= c.term AND c.n <> 0),
flag AS (SELECT *, CASE WHEN p IS NULL OR s > p THEN 1 ELSE 0 END AS isnew FROM (
          SELECT *, lag(e) OVER (PARTITION BY k, status, city, n, kind, yr ORDER BY s) AS p FROM inc) t),
isl AS (SELECT *, SUM(isnew) OVER (PARTITION BY k, status, city, n, kind, yr ORDER BY s
               ROWS UNBOUNDED PRECEDING) AS g FROM flag),
mrg AS (SELECT k, group_name, type_code, status, city, n, kind, yr, g, MIN(s) AS s, MAX(e) AS e
        FROM isl GROUP BY ALL),
trm AS (SELECT *, CASE WHEN nx IS NOT NULL AND e >= nx THEN nx - 1 ELSE e END AS e2 FROM (
          SELECT *, lead(s) OVER (PARTITION BY k, kind ORDER BY s) AS nx FROM mrg) t)
SELECT CAST(k AS VARCHAR) AS "Group_Source_Key", 'Facets' AS "Source_System_Code", s AS "Row_Effective_Date",
       e2 AS "Row_Term_Date", group_name AS "Group_Name", type_code AS "Group_Type_Code",
       status AS "Status_Code", city AS "Address_City", 'US' AS "Country", '101' AS "Renewal_MMDD",
       n AS "Employee_Count", CAST(yr AS INTEGER) AS "Count_as_of_Year",
       CASE kind WHEN 'MLRR' THEN 'Group Response' WHEN 'MLRP' THEN 'Previous Group Response'
                 ELSE 'Default' END AS "Count_Type"
FROM trm WHERE s <= e2
"""

QUERIES = {
    "timeline_slices": (timeline_slices, TIMELINE_SLICES),
    "interval_containment_join": (containment_join, CONTAINMENT),
    "interval_sweep": (swept, CONTAINMENT),
    "interval_left_join": (open_slices, OPEN_SLICES),
    "islands_collapse": (islands_collapse, ISLANDS),
    "islands_collapse_reference": (islands_reference, ISLANDS_REFERENCE),
    "interval_trim_parallel": (interval_trim_parallel, TRIM_PARALLEL),
    "gold_dimension": (gold_dimension, GOLD),
    "gold_code_labels": (gold_code_labels, CODE_LABELS),
    "gold_group_dimension": (gold_group, GOLD_GROUP),
}
