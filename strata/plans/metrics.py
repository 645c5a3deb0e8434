"""Operational and data-quality metrics.

Every metric aggregates its facts first; windows and sorts then run over one row per
day, rule or table, which the calendar and the configuration bound.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.quality import Rule, rule_counts

SUCCESS = "SUCCESS"


def percent(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 2)


def with_duration(runs: DataFrame) -> DataFrame:
    minutes = F.timestamp_diff("MINUTE", F.col("start_time"), F.col("end_time"))
    return runs.withColumn("duration_minutes", minutes)


def run_overview(runs: DataFrame, by: Sequence[str], since: Column) -> DataFrame:
    """Runs, success rate and mean duration per mode since a point in time."""
    recent = with_duration(runs.filter(F.col("start_time") >= since))
    return recent.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        percent(F.count_if(F.col("result_state") == SUCCESS), F.count(F.lit(1))).alias("success_rate"),
        F.round(F.avg("duration_minutes"), 2).alias("avg_minutes"),
    )


def runs_per_day(runs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Runs per day next to those of the day before (0 when there were none)."""
    daily = runs.groupBy(*by, F.col("start_time").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("runs")
    )
    window = Window.partitionBy(*by).orderBy("day")
    before = F.when(
        F.lag("day").over(window) == F.date_sub("day", 1), F.lag("runs").over(window)
    )
    return daily.withColumn("runs_day_before", F.coalesce(before, F.lit(0).cast("bigint")))


def error_counts(errors: DataFrame, by: Sequence[str], seen_at: str, since: Column | None = None) -> DataFrame:
    rows = errors if since is None else errors.filter(F.col(seen_at) >= since)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("occurrences"),
        F.min(seen_at).alias("first_seen"),
        F.max(seen_at).alias("last_seen"),
    )


def top(df: DataFrame, measure: str, n: int = 10, tie_break: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(measure).desc(), *tie_break).limit(n)


def layer_volume(layers: Mapping[str, DataFrame], by: Sequence[str]) -> DataFrame:
    """Records per layer and group, one row each."""
    counted = [
        df.groupBy(*by).agg(F.count(F.lit(1)).alias("records")).withColumn("layer", F.lit(name))
        for name, df in layers.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


def layer_reconciliation(volume: DataFrame, by: Sequence[str], layers: Sequence[str]) -> DataFrame:
    """Records of each layer side by side and the loss between neighbours."""
    wide = volume.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("layer") == x, F.col("records"))), F.lit(0).cast("bigint")).alias(x)
            for x in layers
        ]
    )
    losses = [(F.col(a) - F.col(b)).alias(f"{a}_to_{b}") for a, b in zip(layers, layers[1:])]
    return wide.select("*", *losses)


def unmatched_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present on one side only; each side is made distinct before the join."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    only_left = a.join(b, list(keys), "left_anti").withColumn("side", F.lit("source"))
    only_right = b.join(a, list(keys), "left_anti").withColumn("side", F.lit("target"))
    return only_left.unionByName(only_right)


def scorecard(df: DataFrame, rules: Sequence[Rule], by: Sequence[str]) -> DataFrame:
    """Passed share per severity and group, from evaluated rows."""
    counts = rule_counts(df, rules, by)
    total = F.sum("passed") + F.sum("failed")
    return counts.groupBy(*by, "dq_type").agg(
        F.sum("passed").alias("passed_rules"),
        total.alias("total_rules"),
        percent(F.sum("passed"), total).alias("quality_score"),
    )


def composite_score(scores: DataFrame, by: Sequence[str], weights: Mapping[str, float]) -> DataFrame:
    """Mean score of a group weighted by severity."""
    weight = F.lit(0.0)
    for severity, value in weights.items():
        weight = F.when(F.col("dq_type") == severity, F.lit(float(value))).otherwise(weight)
    weighted = scores.withColumn("w", weight)
    score = F.sum(F.col("quality_score") * F.col("w")) / F.nullif(F.sum("w"), F.lit(0.0))
    return weighted.groupBy(*by).agg(F.round(score, 4).alias("composite_score"))


def rolling_mean(df: DataFrame, by: Sequence[str], day: str, measure: str, days: int, out: str) -> DataFrame:
    """Mean of a daily measure over the last ``days`` calendar days, gaps included."""
    order = Window.partitionBy(*by).orderBy(F.unix_date(F.col(day)))
    return df.withColumn(out, F.round(F.avg(measure).over(order.rangeBetween(1 - days, 0)), 4))


def violations(audit: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bad rows per violated rule."""
    return (
        audit.select(*by, "dq_type", F.explode(F.map_keys("reason")).alias("rule"))
        .groupBy(*by, "dq_type", "rule")
        .agg(F.count(F.lit(1)).alias("violation_count"))
    )


def with_rule_columns(counted: DataFrame, rules: DataFrame) -> DataFrame:
    """Add the column a rule checks. Rules are a configuration table; the planner
    broadcasts it only while its measured size allows."""
    named = rules.select(
        F.col("constraint").alias("rule"),
        F.upper("action").alias("dq_type"),
        "source_column_name",
    ).distinct()
    return counted.join(named, ["rule", "dq_type"])


def pareto(counted: DataFrame, measure: str = "violation_count", tie_break: str = "rule") -> DataFrame:
    """Share and cumulative share of each rule, most violated first."""
    ranked = Window.partitionBy().orderBy(F.col(measure).desc(), tie_break)
    total = F.sum(measure).over(Window.partitionBy())
    running = F.sum(measure).over(ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counted.withColumns(
        {"share_pct": percent(F.col(measure), total), "cumulative_pct": percent(running, total)}
    )


def quarantine_rate(df: DataFrame, is_bad: Column, by: Sequence[str]) -> DataFrame:
    bad = F.count_if(is_bad)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"),
        bad.alias("quarantined"),
        percent(bad, F.count(F.lit(1))).alias("quarantine_pct"),
    )


def completeness(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Filled share per column, counted in one aggregate and turned to rows after it."""
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(f"__{c}") for c in columns]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("__rows").alias("total_records"),
            F.col(f"__{c}").alias("non_null_records"),
            percent(F.col(f"__{c}"), F.col("__rows")).alias("completeness_pct"),
        )
        for c in columns
    ]
    return counted.select(*by, F.inline(F.array(*rows)))


def missing_dates(df: DataFrame, day: Column, by: Sequence[str]) -> DataFrame:
    """Calendar days between the first and last of a group on which it has no row."""
    present = df.select(*by, day.alias("day")).distinct()
    spans = present.groupBy(*by).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    calendar = spans.select(*by, F.explode(F.sequence("a", "b")).alias("day"))
    return calendar.join(present, [*by, "day"], "left_anti")


def conversion_rate(df: DataFrame, casts: Mapping[str, str], by: Sequence[str]) -> DataFrame:
    """Share of the values of a text column that convert to a type."""
    counted = df.groupBy(*by).agg(
        *[F.count(c).alias(f"__n_{c}") for c in casts],
        *[F.count(F.col(c).try_cast(t)).alias(f"__ok_{c}") for c, t in casts.items()],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(t).alias("target_type"),
            F.col(f"__n_{c}").alias("given"),
            F.col(f"__ok_{c}").alias("converted"),
            percent(F.col(f"__ok_{c}"), F.col(f"__n_{c}")).alias("success_pct"),
        )
        for c, t in casts.items()
    ]
    return counted.select(*by, F.inline(F.array(*rows)))


def rule_coverage(columns: DataFrame, rules: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of the columns of a table that at least one rule checks."""
    ruled = rules.select(*by, "source_column_name").distinct().withColumn("__has", F.lit(1))
    joined = columns.join(ruled, [*by, "source_column_name"], "left")
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("columns"),
        F.count("__has").alias("ruled_columns"),
        percent(F.count("__has"), F.count(F.lit(1))).alias("coverage_pct"),
    )


def trend(df: DataFrame, by: Sequence[str], order: str, measure: str) -> DataFrame:
    """Direction of a measure against the row before: up, down, flat, or NULL at first."""
    before = F.lag(measure).over(Window.partitionBy(*by).orderBy(order))
    sign = F.signum(F.col(measure) - before)
    return df.withColumn(
        "trend_direction", F.when(sign > 0, "up").when(sign < 0, "down").when(sign == 0, "flat")
    )


def growth(df: DataFrame, by: Sequence[str], order: str, measure: str) -> DataFrame:
    """Change against the row before, in percent."""
    before = F.lag(measure).over(Window.partitionBy(*by).orderBy(order))
    return df.withColumn("growth_pct", percent(F.col(measure) - before, before))


def source_share(df: DataFrame, by: Sequence[str], source: str) -> DataFrame:
    counted = df.groupBy(*by, source).agg(F.count(F.lit(1)).alias("records"))
    total = F.sum("records").over(Window.partitionBy(*by))
    return counted.withColumn("share_pct", percent(F.col("records"), total))


def freshness(df: DataFrame, day: Column, as_of: Column, by: Sequence[str]) -> DataFrame:
    newest = df.groupBy(*by).agg(F.max(day).alias("newest"))
    return newest.withColumn("age_days", F.datediff(as_of, "newest"))
