"""Operational and data-quality metrics over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality as dq
from strata.operators.quality import Rule
from strata.plans import metrics
from strata.queries.quality import HELD, LINE_RULES, WARNED
from strata.queries.tables import day, month, table


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    """Events as pipeline runs: the value is the duration in minutes."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("scenario"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int"))).alias("end_time"),
        F.when(F.col("value") > 90, "FAILED").otherwise("SUCCESS").alias("result_state"),
        F.get_json_object("props", "$.k").alias("error_code"),
    )


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    since = F.lit("2024-01-05").cast("timestamp_ntz")
    return metrics.run_overview(_runs(spark, folder), ["scenario"], since)


RUN_LOG = """
SELECT event_type AS scenario, COUNT(*) AS runs,
       ROUND(100.0 * COUNT(*) FILTER (WHERE value <= 90) / COUNT(*), 2) AS success_rate,
       ROUND(AVG(floor(value)), 2) AS avg_minutes
FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY 1
"""


def runs_per_day(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.runs_per_day(_runs(spark, folder), ["scenario"])


RUNS_PER_DAY = """
WITH d AS (SELECT event_type AS scenario, CAST(ts AS DATE) AS day, COUNT(*) AS runs FROM events GROUP BY 1, 2)
SELECT d.scenario, d.day, d.runs, coalesce(b.runs, 0) AS runs_day_before
FROM d LEFT JOIN d b ON b.scenario = d.scenario AND b.day = d.day - 1
"""


def top_errors(spark: SparkSession, folder: str) -> DataFrame:
    failed = _runs(spark, folder).filter(F.col("result_state") == "FAILED")
    counted = metrics.error_counts(
        failed, ["error_code", "scenario"], "start_time", F.lit("2024-01-10").cast("timestamp_ntz")
    )
    shown = counted.withColumns({c: F.col(c).cast("date") for c in ("first_seen", "last_seen")})
    return metrics.top(shown, "occurrences", 10, ["error_code", "scenario"])


TOP_ERRORS = """
SELECT json_extract_string(props, '$.k') AS error_code, event_type AS scenario, COUNT(*) AS occurrences,
       CAST(MIN(ts) AS DATE) AS first_seen, CAST(MAX(ts) AS DATE) AS last_seen
FROM events WHERE value > 90 AND ts >= TIMESTAMP '2024-01-10'
GROUP BY 1, 2 ORDER BY occurrences DESC, error_code, scenario LIMIT 10
"""


def layer_volume(spark: SparkSession, folder: str) -> DataFrame:
    """Lines per layer and month, side by side with the loss between layers."""
    lines = table(spark, folder, "lineitem").withColumn("business_date", month("l_shipdate"))
    clean = dq.clean_rows(dq.assess(lines, LINE_RULES))
    gold = clean.select("business_date", "l_orderkey", "l_linenumber").distinct()
    volume = metrics.layer_volume({"bronze": lines, "silver": clean, "gold": gold}, ["business_date"])
    return metrics.layer_reconciliation(volume, ["business_date"], ["bronze", "silver", "gold"])


LAYER_VOLUME = f"""
SELECT business_date, bronze, silver, gold, bronze - silver AS bronze_to_silver, silver - gold AS silver_to_gold
FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS business_date, COUNT(*) AS bronze,
             COUNT(*) FILTER (WHERE NOT {HELD}) AS silver,
             COUNT(DISTINCT (l_orderkey, l_linenumber)) FILTER (WHERE NOT {HELD}) AS gold
      FROM lineitem GROUP BY 1)
"""


def reconcile_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without lines and lines without orders."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_key"))
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    return metrics.unmatched_keys(orders, lines, ["order_key"])


RECONCILE_KEYS = """
SELECT o_orderkey AS order_key, 'source' AS side FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL
SELECT DISTINCT l_orderkey, 'target' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
"""

EVENT_RULES = [
    Rule("QUARANTINE", "value > 100"),
    Rule("WARN", "event_type = 'error'"),
    Rule("WARN", "value < 1"),
]


def scorecard(spark: SparkSession, folder: str) -> DataFrame:
    """Daily quality score per severity with its 30-day rolling mean."""
    events = table(spark, folder, "events").withColumn("business_date", day("ts"))
    scores = metrics.scorecard(events, EVENT_RULES, ["business_date"])
    return metrics.rolling_mean(scores, ["dq_type"], "business_date", "quality_score", 30, "rolling")


_SCORES = """
q AS (SELECT CAST(ts AS DATE) AS business_date, 'QUARANTINE' AS dq_type,
             COUNT(*) FILTER (WHERE NOT value > 100) AS passed_rules, COUNT(*) AS total_rules
      FROM events GROUP BY 1),
w AS (SELECT CAST(ts AS DATE) AS business_date, 'WARN' AS dq_type,
             COUNT(*) FILTER (WHERE event_type <> 'error') + COUNT(*) FILTER (WHERE NOT value < 1) AS passed_rules,
             2 * COUNT(*) AS total_rules
      FROM events WHERE NOT value > 100 GROUP BY 1),
sc AS (SELECT *, ROUND(100.0 * passed_rules / total_rules, 2) AS quality_score
       FROM (SELECT * FROM q UNION ALL SELECT * FROM w))
"""
SCORECARD = f"""
WITH {_SCORES}
SELECT business_date, dq_type, passed_rules, total_rules, quality_score,
       ROUND(AVG(quality_score) OVER (PARTITION BY dq_type ORDER BY business_date
             RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW), 4) AS rolling
FROM sc
"""


def composite(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("business_date", day("ts"))
    scores = metrics.scorecard(events, EVENT_RULES, ["business_date"])
    weights = {"QUARANTINE": 3.0, "WARN": 1.0}
    return metrics.composite_score(scores, ["business_date"], weights)


COMPOSITE = f"""
WITH {_SCORES}
SELECT business_date, ROUND(SUM(quality_score * w) / SUM(w), 4) AS composite_score
FROM (SELECT *, CASE dq_type WHEN 'QUARANTINE' THEN 3.0 ELSE 1.0 END AS w FROM sc) GROUP BY 1
"""


def _audit(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumn("business_date", month("l_shipdate"))
    return dq.audit_records(dq.assess(lines, LINE_RULES), "D_Order", "DF_Line", "lineitem")


def top_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Most violated rules with the column they check and their share."""
    rules = spark.createDataFrame(
        [(r.constraint, r.action, r.column) for r in LINE_RULES],
        "constraint string, action string, source_column_name string",
    )
    counted = metrics.with_rule_columns(metrics.violations(_audit(spark, folder)), rules)
    return metrics.top(metrics.pareto(counted), "violation_count", 10, ["rule"])


_VIOLATIONS = f"""
SELECT 'QUARANTINE' AS dq_type, 'l_discount = 0' AS rule, 'l_discount' AS source_column_name,
       COUNT(*) FILTER (WHERE l_discount = 0) AS violation_count FROM lineitem
UNION ALL SELECT 'QUARANTINE', 'l_quantity > 45 and l_returnflag = ''R''', 'l_quantity',
       COUNT(*) FILTER (WHERE l_quantity > 45 AND l_returnflag = 'R') FROM lineitem
UNION ALL SELECT 'WARN', 'l_tax = 0', 'l_tax', COUNT(*) FILTER (WHERE NOT {HELD} AND l_tax = 0) FROM lineitem
UNION ALL SELECT 'WARN', 'trim(l_linestatus) = ''O'' and l_quantity < 3', 'l_linestatus',
       COUNT(*) FILTER (WHERE NOT {HELD} AND l_linestatus = 'O' AND l_quantity < 3) FROM lineitem
"""
TOP_VIOLATIONS = f"""
SELECT *, ROUND(100.0 * violation_count / SUM(violation_count) OVER (), 2) AS share_pct,
       ROUND(100.0 * SUM(violation_count) OVER (ORDER BY violation_count DESC, rule ROWS UNBOUNDED PRECEDING)
             / SUM(violation_count) OVER (), 2) AS cumulative_pct
FROM ({_VIOLATIONS}) WHERE violation_count > 0
ORDER BY violation_count DESC, rule LIMIT 10
"""


def violation_trend(spark: SparkSession, folder: str) -> DataFrame:
    """Violations per rule and month and where they are heading."""
    counted = metrics.violations(_audit(spark, folder), ["business_date"])
    return metrics.trend(counted, ["dq_type", "rule"], "business_date", "violation_count")


VIOLATION_TREND = f"""
WITH v AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS business_date, 'QUARANTINE' AS dq_type,
         'l_discount = 0' AS rule FROM lineitem WHERE l_discount = 0
  UNION ALL SELECT CAST(date_trunc('month', l_shipdate) AS DATE), 'QUARANTINE',
         'l_quantity > 45 and l_returnflag = ''R''' FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'
  UNION ALL SELECT CAST(date_trunc('month', l_shipdate) AS DATE), 'WARN', 'l_tax = 0'
         FROM lineitem WHERE NOT {HELD} AND l_tax = 0
  UNION ALL SELECT CAST(date_trunc('month', l_shipdate) AS DATE), 'WARN',
         'trim(l_linestatus) = ''O'' and l_quantity < 3'
         FROM lineitem WHERE NOT {HELD} AND l_linestatus = 'O' AND l_quantity < 3),
c AS (SELECT business_date, dq_type, rule, COUNT(*) AS violation_count FROM v GROUP BY 1, 2, 3),
l AS (SELECT *, lag(violation_count) OVER (PARTITION BY dq_type, rule ORDER BY business_date) AS b FROM c)
SELECT business_date, dq_type, rule, violation_count,
       CASE WHEN violation_count > b THEN 'up' WHEN violation_count < b THEN 'down'
            WHEN violation_count = b THEN 'flat' END AS trend_direction
FROM l
"""


def quarantine_rate(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return metrics.quarantine_rate(lines, F.expr(HELD), [month("l_shipdate").alias("business_date")])


QUARANTINE_RATE = f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS business_date, COUNT(*) AS records,
       COUNT(*) FILTER (WHERE {HELD}) AS quarantined,
       ROUND(100.0 * COUNT(*) FILTER (WHERE {HELD}) / COUNT(*), 2) AS quarantine_pct
FROM lineitem GROUP BY 1
"""


def completeness(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumns(
        {
            "business_date": day("ts"),
            "event_type": F.nullif("event_type", F.lit("error")),
            "value": F.when(F.col("value") >= 5, F.col("value")),
        }
    )
    return metrics.completeness(events, ["event_type", "value", "user_id"], ["business_date"])


def _complete_sql(column: str, filled: str) -> str:
    return (
        f"SELECT CAST(ts AS DATE) AS business_date, '{column}' AS column_name, COUNT(*) AS total_records, "
        f"COUNT(*) FILTER (WHERE {filled}) AS non_null_records, "
        f"ROUND(100.0 * COUNT(*) FILTER (WHERE {filled}) / COUNT(*), 2) AS completeness_pct "
        "FROM events GROUP BY 1"
    )


COMPLETENESS = " UNION ALL ".join(
    [
        _complete_sql("event_type", "event_type <> 'error'"),
        _complete_sql("value", "value >= 5"),
        _complete_sql("user_id", "TRUE"),
    ]
)


def missing_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Days without an order per nation of the customer."""
    days = table(spark, folder, "orders").select("o_custkey", day("o_orderdate").alias("day")).distinct()
    orders = days.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return metrics.missing_dates(orders, F.col("day"), ["c_nationkey"])


MISSING_DATES = """
WITH p AS (SELECT DISTINCT c_nationkey, CAST(o_orderdate AS DATE) AS day FROM orders JOIN customer ON o_custkey = c_custkey),
c AS (SELECT c_nationkey, CAST(unnest(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY)) AS DATE) AS day
      FROM p GROUP BY 1)
SELECT c.c_nationkey, c.day FROM c ANTI JOIN p ON p.c_nationkey = c.c_nationkey AND p.day = c.day
"""


def conversion(spark: SparkSession, folder: str) -> DataFrame:
    """Text that should be numbers and dates."""
    kind = F.col("event_type")
    events = table(spark, folder, "events").select(
        day("ts").alias("business_date"),
        F.when(kind == "error", "n/a")
        .when(kind == "view", F.lit(None))
        .otherwise(F.col("user_id").cast("string"))
        .alias("amount"),
        F.when(kind == "click", "2025-13-99")
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("booked"),
    )
    return metrics.conversion_rate(events, {"amount": "int", "booked": "date"}, ["business_date"])


CONVERSION = """
WITH e AS (SELECT CAST(ts AS DATE) AS business_date,
    CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type = 'view' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS amount,
    CASE WHEN event_type = 'click' THEN '2025-13-99' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS booked FROM events)
SELECT business_date, 'amount' AS column_name, 'int' AS target_type, COUNT(amount) AS given,
       COUNT(TRY_CAST(amount AS INTEGER)) AS converted,
       ROUND(100.0 * COUNT(TRY_CAST(amount AS INTEGER)) / nullif(COUNT(amount), 0), 2) AS success_pct
FROM e GROUP BY 1
UNION ALL
SELECT business_date, 'booked', 'date', COUNT(booked), COUNT(TRY_CAST(booked AS DATE)),
       ROUND(100.0 * COUNT(TRY_CAST(booked AS DATE)) / nullif(COUNT(booked), 0), 2)
FROM e GROUP BY 1
"""


def monthly_growth(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    monthly = orders.groupBy("o_orderpriority", month("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("records")
    )
    return metrics.growth(monthly, ["o_orderpriority"], "month", "records")


MONTHLY_GROWTH = """
SELECT o_orderpriority, month, records, ROUND(100.0 * (records - b) / b, 2) AS growth_pct FROM (
  SELECT *, lag(records) OVER (PARTITION BY o_orderpriority ORDER BY month) AS b FROM (
    SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS records
    FROM orders GROUP BY 1, 2))
"""


def source_share(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return metrics.source_share(documents, ["lang"], "source")


SOURCE_SHARE = """
SELECT lang, source, COUNT(*) AS records,
       ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY lang), 2) AS share_pct
FROM documents GROUP BY 1, 2
"""


def freshness(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    as_of = F.lit("2025-04-08").cast("date")
    return metrics.freshness(orders, day("o_orderdate"), as_of, ["o_orderstatus"])


FRESHNESS = """
SELECT o_orderstatus, MAX(CAST(o_orderdate AS DATE)) AS newest,
       CAST(DATE '2025-04-08' - MAX(CAST(o_orderdate AS DATE)) AS INTEGER) AS age_days
FROM orders GROUP BY 1
"""


def rule_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as columns of a table per brand; those priced above 1000 have a rule."""
    parts = table(spark, folder, "part").select(
        F.col("p_brand").alias("target_table"),
        F.col("p_name").alias("source_column_name"),
        "p_retailprice",
    )
    columns = parts.select("target_table", "source_column_name").distinct()
    return metrics.rule_coverage(columns, parts.filter("p_retailprice > 1000"), ["target_table"])


RULE_COVERAGE = """
SELECT target_table, COUNT(*) AS columns, COUNT(*) FILTER (WHERE ruled) AS ruled_columns,
       ROUND(100.0 * COUNT(*) FILTER (WHERE ruled) / COUNT(*), 2) AS coverage_pct
FROM (SELECT p_brand AS target_table, p_name, bool_or(p_retailprice > 1000) AS ruled FROM part GROUP BY 1, 2)
GROUP BY 1
"""


def daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Records, held and warned rows per month and ship state."""
    lines = table(spark, folder, "lineitem")
    return lines.groupBy(month("l_shipdate").alias("business_date"), "l_linestatus").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.expr(HELD)).alias("error_count"),
        F.count_if(F.expr(f"{WARNED} AND NOT {HELD}")).alias("warning_count"),
        metrics.percent(F.count_if(~F.expr(HELD)), F.count(F.lit(1))).alias("quality_score"),
    )


DAILY_SUMMARY = f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS business_date, l_linestatus, COUNT(*) AS total_records,
       COUNT(*) FILTER (WHERE {HELD}) AS error_count, COUNT(*) FILTER (WHERE {WARNED} AND NOT {HELD}) AS warning_count,
       ROUND(100.0 * COUNT(*) FILTER (WHERE NOT {HELD}) / COUNT(*), 2) AS quality_score
FROM lineitem GROUP BY 1, 2
"""

QUERIES = {
    "metrics_run_log": (run_log, RUN_LOG),
    "metrics_runs_per_day": (runs_per_day, RUNS_PER_DAY),
    "metrics_top_errors": (top_errors, TOP_ERRORS),
    "metrics_layer_volume": (layer_volume, LAYER_VOLUME),
    "metrics_reconcile_keys": (reconcile_keys, RECONCILE_KEYS),
    "metrics_scorecard": (scorecard, SCORECARD),
    "metrics_composite_score": (composite, COMPOSITE),
    "metrics_top_violations": (top_violations, TOP_VIOLATIONS),
    "metrics_violation_trend": (violation_trend, VIOLATION_TREND),
    "metrics_quarantine_rate": (quarantine_rate, QUARANTINE_RATE),
    "metrics_completeness": (completeness, COMPLETENESS),
    "metrics_missing_dates": (missing_dates, MISSING_DATES),
    "metrics_conversion": (conversion, CONVERSION),
    "metrics_growth": (monthly_growth, MONTHLY_GROWTH),
    "metrics_source_share": (source_share, SOURCE_SHARE),
    "metrics_freshness": (freshness, FRESHNESS),
    "metrics_rule_coverage": (rule_coverage, RULE_COVERAGE),
    "metrics_daily_summary": (daily_summary, DAILY_SUMMARY),
}
