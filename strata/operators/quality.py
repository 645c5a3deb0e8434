"""Data-quality rules with three outcomes: fail the run, quarantine the row, or warn.

A rule is a violation predicate: the row is bad where it is TRUE. NULL counts as
not violated, so every input row is either clean or quarantined.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

FAIL, QUARANTINE, WARN, DROP, KEEP = "FAIL", "QUARANTINE", "WARN", "DROP", "KEEP"
VIOLATIONS = "__violations"
_EMPTY = "CAST(map() AS map<string, boolean>)"


class QualityFailure(RuntimeError):
    """Raised by the fail gate with the number of bad rows per rule."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        super().__init__("; ".join(f"{rule}: {n} rows" for rule, n in counts.items()))


@dataclass(frozen=True)
class Rule:
    action: str
    constraint: str
    column: str = ""


def of_action(rules: Iterable[Rule], action: str) -> list[str]:
    """Distinct rule texts of one severity, in the order given."""
    return list(dict.fromkeys(r.constraint for r in rules if r.action.upper() == action))


def violated(constraint: str) -> Column:
    return F.coalesce(F.expr(f"({constraint})"), F.lit(False))


def _found(constraints: Sequence[str]) -> Column:
    if not constraints:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(violated(c), F.lit(c)) for c in constraints]))


def assess(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Evaluate every rule; per severity a flag and the array of violated texts.

    Splits test the flags, so the texts are only built for rows that become records.
    """
    rules = list(rules)
    found = []
    for action in (FAIL, QUARANTINE, WARN, DROP):
        constraints = of_action(rules, action)
        flag = reduce(lambda a, b: a | b, [violated(c) for c in constraints], F.lit(False))
        found += [flag.alias(f"is_{action.lower()}"), _found(constraints).alias(action.lower())]
    return df.withColumn(VIOLATIONS, F.struct(*found))


def _any(action: str) -> Column:
    return F.col(VIOLATIONS)[f"is_{action.lower()}"]


def annotate(
    df: DataFrame, constraints: Sequence[str], strict_nulls: bool = False
) -> DataFrame:
    """Add ``is_valid`` and ``action_details`` (rule text -> passed) for one severity.

    ``strict_nulls`` leaves ``is_valid`` NULL when a rule sees NULL, so the row
    matches neither side of a split; only for comparison.
    """
    constraints = list(dict.fromkeys(constraints))
    if not constraints:
        return df.withColumns({"is_valid": F.lit(True), "action_details": F.expr(_EMPTY)})
    passed = [
        F.expr(f"NOT ({c})") if strict_nulls else ~violated(c) for c in constraints
    ]
    valid = passed[0]
    for one in passed[1:]:
        valid = valid & one
    outcome = F.map_from_arrays(F.array(*[F.lit(c) for c in constraints]), F.array(*passed))
    return df.withColumns(
        {"is_valid": valid, "action_details": F.when(~F.coalesce(valid, F.lit(True)), outcome)}
    )


def failing_rules(details: Column) -> Column:
    return F.map_filter(details, lambda rule, passed: ~passed)


def fail_gate(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Pass rows through; the job stops at the first row that violates a fail rule.

    The check sits in a filter, so it costs no extra pass and cannot be pruned.
    """
    constraints = of_action(rules, FAIL)
    if not constraints:
        return df
    bad = _found(constraints)
    message = F.concat(F.lit("fail rule violated: "), F.array_join(bad, " | "))
    return df.filter(
        F.when(F.size(bad) == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    )


def check_fail_rules(df: DataFrame, rules: Iterable[Rule]) -> None:
    """Count violations of all fail rules in one pass and raise before anything is written."""
    constraints = of_action(rules, FAIL)
    if not constraints:
        return
    row = df.agg(*[F.count_if(violated(c)).alias(f"r{i}") for i, c in enumerate(constraints)]).first()
    counts = {c: row[i] for i, c in enumerate(constraints) if row[i]}
    if counts:
        raise QualityFailure(counts)


def clean_rows(assessed: DataFrame) -> DataFrame:
    """Rows that go on: not quarantined and not dropped. Warned rows stay."""
    return assessed.filter(~_any(QUARANTINE) & ~_any(DROP)).drop(VIOLATIONS)


def warned_rows(assessed: DataFrame) -> DataFrame:
    """Rows that go on, with the warn stage's ``is_valid`` and reasons."""
    passing = assessed.filter(~_any(QUARANTINE) & ~_any(DROP))
    return passing.withColumns(
        {"is_valid": ~_any(WARN), "warn_reasons": F.col(VIOLATIONS)["warn"]}
    ).drop(VIOLATIONS)


def audit_records(
    assessed: DataFrame, dimension_table: str, target_table: str, validated_table: str
) -> DataFrame:
    """One record per bad row, with the rules of the severity that found it bad.

    A quarantined row never reaches the warn stage, so no row gives two records.
    """
    content = [c for c in assessed.columns if c != VIOLATIONS]
    held = _any(QUARANTINE)
    bad = assessed.filter(held | (_any(WARN) & ~_any(DROP)))
    rules = F.when(held, F.col(VIOLATIONS)["quarantine"]).otherwise(F.col(VIOLATIONS)["warn"])
    reason = F.map_from_arrays(rules, F.transform(rules, lambda r: F.lit(False)))

    def own(name: str, kind: str) -> Column:
        return F.col(name) if name in content else F.lit(None).cast(kind).alias(name)

    return bad.select(
        F.lit(dimension_table).alias("dimension_table"),
        F.lit(target_table).alias("target_table"),
        F.lit(validated_table).alias("validated_table"),
        own("source", "string"),
        own("source_schema", "string"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in content])).alias("input_details"),
        reason.alias("reason"),
        F.when(held, QUARANTINE).otherwise(WARN).alias("dq_type"),
        own("business_date", "date"),
        own("processing_time", "bigint"),
    )


def rule_counts(df: DataFrame, rules: Iterable[Rule], by: Sequence[str] = ()) -> DataFrame:
    """Passed and failed rows per rule over the rows that reach its stage; one pass."""
    rules = list(rules)
    quarantine = of_action(rules, QUARANTINE)
    held = F.lit(False)
    for constraint in quarantine:
        held = held | violated(constraint)
    stages = [(FAIL, F.lit(True)), (QUARANTINE, F.lit(True)), (WARN, ~held)]
    counted, named = [], []
    for action, reaches in stages:
        for constraint in of_action(rules, action):
            bad, total = f"b{len(named)}", f"t{len(named)}"
            counted += [
                F.count_if(reaches & violated(constraint)).alias(bad),
                F.count_if(reaches).alias(total),
            ]
            named.append(
                F.struct(
                    F.lit(action).alias("dq_type"),
                    F.lit(constraint).alias("rule"),
                    (F.col(total) - F.col(bad)).alias("passed"),
                    F.col(bad).alias("failed"),
                )
            )
    totals = df.groupBy(*by).agg(*counted)
    return totals.select(*by, F.inline(F.array(*named)))


def observe_rules(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, Observation]:
    """Count violations as a side effect of whatever action runs on the result."""
    texts = list(dict.fromkeys(r.constraint for r in rules))
    seen = Observation()
    metrics = [F.count_if(violated(t)).alias(t) for t in texts]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen


def changed_since(df: DataFrame, processing_time: int) -> DataFrame:
    """Rows stamped at or after a run start, to limit the checks to new data."""
    return df.filter(F.col("processing_time") >= processing_time)
