"""Quality rules over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality as dq
from strata.operators.quality import Rule
from strata.queries.tables import day, table

LINE_RULES = [
    Rule("FAIL", "l_orderkey is null", "l_orderkey"),
    Rule("FAIL", "l_quantity < 0", "l_quantity"),
    Rule("QUARANTINE", "l_discount = 0", "l_discount"),
    Rule("QUARANTINE", "l_quantity > 45 and l_returnflag = 'R'", "l_quantity"),
    Rule("quarantine", "l_discount = 0", "l_discount"),
    Rule("WARN", "l_tax = 0", "l_tax"),
    Rule("WARN", "trim(l_linestatus) = 'O' and l_quantity < 3", "l_linestatus"),
]
HELD = "(l_discount = 0 OR (l_quantity > 45 AND l_returnflag = 'R'))"
WARNED = "(l_tax = 0 OR (l_linestatus = 'O' AND l_quantity < 3))"


def fail_gate(spark: SparkSession, folder: str) -> DataFrame:
    passed = dq.fail_gate(table(spark, folder, "lineitem"), LINE_RULES)
    return passed.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


FAIL_GATE = """
SELECT l_returnflag, COUNT(*) AS n, ROUND(SUM(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1
"""


def quarantine_clean(spark: SparkSession, folder: str) -> DataFrame:
    assessed = dq.assess(table(spark, folder, "lineitem"), LINE_RULES)
    return dq.clean_rows(assessed).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


QUARANTINE_CLEAN = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE NOT {HELD}
"""


def quarantine_audit(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").withColumns(
        {
            "source": F.lit("Not Used"),
            "source_schema": F.lit("dbo"),
            "business_date": day("l_shipdate"),
            "processing_time": F.lit(1744070400).cast("long"),
        }
    )
    records = dq.audit_records(dq.assess(rows, LINE_RULES), "D_Order", "DF_Line", "lineitem")
    details = F.col("input_details")
    return records.select(
        "dimension_table", "target_table", "validated_table", "source", "source_schema", "dq_type",
        "business_date", "processing_time",
        F.array_join(F.array_sort(F.map_keys("reason")), " | ").alias("rules"),
        F.get_json_object(details, "$.l_orderkey").cast("bigint").alias("l_orderkey"),
        F.get_json_object(details, "$.l_extendedprice").cast("double").alias("l_extendedprice"),
    )


QUARANTINE_AUDIT = f"""
SELECT 'D_Order' AS dimension_table, 'DF_Line' AS target_table, 'lineitem' AS validated_table,
       'Not Used' AS source, 'dbo' AS source_schema,
       CASE WHEN {HELD} THEN 'QUARANTINE' ELSE 'WARN' END AS dq_type,
       CAST(l_shipdate AS DATE) AS business_date, CAST(1744070400 AS BIGINT) AS processing_time,
       CASE WHEN {HELD} THEN concat_ws(' | ',
                 CASE WHEN l_discount = 0 THEN 'l_discount = 0' END,
                 CASE WHEN l_quantity > 45 AND l_returnflag = 'R'
                      THEN 'l_quantity > 45 and l_returnflag = ''R''' END)
            ELSE concat_ws(' | ',
                 CASE WHEN l_tax = 0 THEN 'l_tax = 0' END,
                 CASE WHEN l_linestatus = 'O' AND l_quantity < 3
                      THEN 'trim(l_linestatus) = ''O'' and l_quantity < 3' END) END AS rules,
       l_orderkey, l_extendedprice
FROM lineitem WHERE {HELD} OR {WARNED}
"""

CUSTOMER_RULES = [
    Rule("WARN", "c_acctbal < 0", "c_acctbal"),
    Rule("WARN", "trim(c_mktsegment) = 'MACHINERY'", "c_mktsegment"),
]


def warn_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    rows = dq.warned_rows(dq.assess(table(spark, folder, "customer"), CUSTOMER_RULES))
    return rows.select(
        "c_custkey", "is_valid", F.array_join(F.array_sort("warn_reasons"), " | ").alias("reasons")
    )


WARN_PASSTHROUGH = """
SELECT c_custkey, NOT (c_acctbal < 0 OR c_mktsegment = 'MACHINERY') AS is_valid,
       concat_ws(' | ', CASE WHEN c_acctbal < 0 THEN 'c_acctbal < 0' END,
                 CASE WHEN c_mktsegment = 'MACHINERY' THEN 'trim(c_mktsegment) = ''MACHINERY''' END) AS reasons
FROM customer
"""


def outcome_map(spark: SparkSession, folder: str) -> DataFrame:
    """Validity and the rules that failed, from the outcome map of one severity."""
    texts = dq.of_action(CUSTOMER_RULES, "WARN")
    rows = dq.annotate(table(spark, folder, "customer"), texts)
    failed = F.map_keys(dq.failing_rules(F.col("action_details")))
    return rows.select(
        "c_custkey",
        "is_valid",
        F.size(F.map_keys("action_details")).alias("checked"),
        F.array_join(F.array_sort(failed), " | ").alias("failed"),
    )


OUTCOME_MAP = """
SELECT c_custkey, NOT bad AS is_valid, CASE WHEN bad THEN 2 END AS checked,
       CASE WHEN bad THEN concat_ws(' | ', CASE WHEN c_acctbal < 0 THEN 'c_acctbal < 0' END,
            CASE WHEN c_mktsegment = 'MACHINERY' THEN 'trim(c_mktsegment) = ''MACHINERY''' END) END AS failed
FROM (SELECT *, (c_acctbal < 0 OR c_mktsegment = 'MACHINERY') AS bad FROM customer)
"""


def rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    return dq.rule_counts(table(spark, folder, "lineitem"), LINE_RULES)


def _count_sql(action: str, rule: str, test: str, reach: str) -> str:
    quoted = rule.replace("'", "''")
    return (
        f"SELECT '{action}' AS dq_type, '{quoted}' AS rule, "
        f"COUNT(*) FILTER (WHERE {reach} AND NOT ({test})) AS passed, "
        f"COUNT(*) FILTER (WHERE {reach} AND ({test})) AS failed FROM lineitem"
    )


RULE_COUNTS = " UNION ALL ".join(
    [
        _count_sql("FAIL", "l_orderkey is null", "l_orderkey IS NULL", "TRUE"),
        _count_sql("FAIL", "l_quantity < 0", "l_quantity < 0", "TRUE"),
        _count_sql("QUARANTINE", "l_discount = 0", "l_discount = 0", "TRUE"),
        _count_sql(
            "QUARANTINE",
            "l_quantity > 45 and l_returnflag = 'R'",
            "l_quantity > 45 AND l_returnflag = 'R'",
            "TRUE",
        ),
        _count_sql("WARN", "l_tax = 0", "l_tax = 0", f"NOT {HELD}"),
        _count_sql(
            "WARN",
            "trim(l_linestatus) = 'O' and l_quantity < 3",
            "l_linestatus = 'O' AND l_quantity < 3",
            f"NOT {HELD}",
        ),
    ]
)


def drop_keep(spark: SparkSession, folder: str) -> DataFrame:
    """DROP discards without a record, KEEP changes nothing."""
    rules = [
        Rule("DROP", "c_mktsegment = 'FURNITURE'"),
        Rule("KEEP", "c_acctbal < 100"),
        Rule("WARN", "c_acctbal < 0"),
    ]
    rows = dq.warned_rows(dq.assess(table(spark, folder, "customer"), rules))
    return rows.select("c_custkey", "c_mktsegment", "is_valid")


DROP_KEEP = """
SELECT c_custkey, c_mktsegment, c_acctbal >= 0 AS is_valid FROM customer WHERE c_mktsegment <> 'FURNITURE'
"""


def changed_since(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn(
        "processing_time", F.unix_date(day("ts")).cast("long") * 86400
    )
    recent = dq.changed_since(events, 1705708800)
    return recent.select("event_id", "user_id", "event_type", "processing_time")


CHANGED_SINCE = """
SELECT event_id, user_id, event_type,
       CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) * 86400 AS processing_time
FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20'
"""


def null_semantics(spark: SparkSession, folder: str) -> DataFrame:
    """A rule that sees NULL leaves the row valid; the strict reading has no answer."""
    rows = table(spark, folder, "events").withColumn(
        "event_type", F.nullif("event_type", F.lit("error"))
    )
    lenient = dq.annotate(rows, ["trim(event_type) = 'click'"])
    strict = dq.annotate(
        lenient.withColumnRenamed("is_valid", "lenient_valid").drop("action_details"),
        ["trim(event_type) = 'click'"],
        strict_nulls=True,
    )
    return strict.select("event_id", "lenient_valid", F.col("is_valid").alias("strict_valid"))


NULL_SEMANTICS = """
SELECT event_id, event_type <> 'click' AS lenient_valid,
       CASE WHEN event_type <> 'error' THEN event_type <> 'click' END AS strict_valid
FROM events
"""

QUERIES = {
    "dq_fail_gate": (fail_gate, FAIL_GATE),
    "dq_quarantine_clean": (quarantine_clean, QUARANTINE_CLEAN),
    "dq_quarantine_audit": (quarantine_audit, QUARANTINE_AUDIT),
    "dq_warn_passthrough": (warn_passthrough, WARN_PASSTHROUGH),
    "dq_outcome_map": (outcome_map, OUTCOME_MAP),
    "dq_rule_counts": (rule_counts, RULE_COUNTS),
    "dq_drop_keep": (drop_keep, DROP_KEEP),
    "dq_changed_since": (changed_since, CHANGED_SINCE),
    "dq_null_semantics": (null_semantics, NULL_SEMANTICS),
}
