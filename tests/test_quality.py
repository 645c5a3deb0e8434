import json

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as dq
from strata.operators.quality import Rule

SEEN = "x string, n int"


def test_null_is_not_a_violation_and_no_row_is_lost(spark):
    df = spark.createDataFrame([("UNK",), (" UNK ",), ("ok",), (None,)], "x string")
    assessed = dq.assess(df, [Rule("QUARANTINE", "trim(x)='UNK'")])
    clean = dq.clean_rows(assessed)
    audit = dq.audit_records(assessed, "d", "t", "v")
    assert clean.count() == 2 and audit.count() == 2
    assert clean.filter("x is null").count() == 1


def test_strict_nulls_lose_the_row(spark):
    df = spark.createDataFrame([("UNK",), ("ok",), (None,)], "x string")
    strict = dq.annotate(df, ["trim(x)='UNK'"], strict_nulls=True)
    assert strict.filter("is_valid").count() == 1 and strict.filter("not is_valid").count() == 1


def test_reasons_list_each_rule_once(spark):
    df = spark.createDataFrame([("UNK", 0), ("ok", 1)], SEEN)
    rules = [Rule("QUARANTINE", "x='UNK'"), Rule("quarantine", "n = 0"), Rule("QUARANTINE", "x='UNK'")]
    record = dq.audit_records(dq.assess(df, rules), "d", "t", "v").collect()
    assert len(record) == 1
    assert record[0].reason == {"x='UNK'": False, "n = 0": False}
    assert json.loads(record[0].input_details) == {"x": "UNK", "n": 0}


def test_no_rules(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], SEEN)
    annotated = dq.annotate(df, []).collect()
    assert [r.is_valid for r in annotated] == [True, True]
    assert [r.action_details for r in annotated] == [{}, {}]
    assert dq.audit_records(dq.assess(df, []), "d", "t", "v").count() == 0


def test_outcome_map_holds_every_rule_of_a_bad_row(spark):
    df = spark.createDataFrame([("UNK", 1)], SEEN)
    row = dq.annotate(df, ["x='UNK'", "n = 0"])
    row = row.withColumn("failed", dq.failing_rules(F.col("action_details"))).first()
    assert row.action_details == {"x='UNK'": False, "n = 0": True}
    assert row.failed == {"x='UNK'": False}


def test_fail_gate_stops_the_job(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], SEEN)
    rules = [Rule("FAIL", "x is null")]
    with pytest.raises(Exception, match="fail rule violated: x is null"):
        dq.fail_gate(df, rules).select("n").count()
    with pytest.raises(dq.QualityFailure) as failure:
        dq.check_fail_rules(df, [*rules, Rule("FAIL", "n > 5")])
    assert failure.value.counts == {"x is null": 1}
    assert dq.fail_gate(df, [Rule("FAIL", "n > 5")]).count() == 2


def test_warn_keeps_the_row_and_records_it(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], SEEN)
    rules = [Rule("WARN", "n < 2"), Rule("QUARANTINE", "x = 'a'"), Rule("DROP", "x = 'c'")]
    assessed = dq.assess(df, rules)
    assert [(r.x, r.is_valid) for r in dq.warned_rows(assessed).collect()] == [("b", False)]
    kinds = {r.dq_type for r in dq.audit_records(assessed, "d", "t", "v").collect()}
    assert kinds == {"QUARANTINE", "WARN"}
    assert dq.audit_records(assessed, "d", "t", "v").count() == 2


def test_observed_counts(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1)], SEEN)
    watched, seen = dq.observe_rules(df, [Rule("WARN", "n = 0"), Rule("WARN", "x = 'z'")])
    assert watched.count() == 2
    assert seen.get == {"rows": 2, "n = 0": 1, "x = 'z'": 0}


def test_empty_input_keeps_schema(spark):
    df = spark.createDataFrame([], SEEN)
    assessed = dq.assess(df, [Rule("QUARANTINE", "n = 0")])
    assert dq.clean_rows(assessed).columns == ["x", "n"]
    assert dq.audit_records(assessed, "d", "t", "v").count() == 0
