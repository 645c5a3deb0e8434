from datetime import date, datetime

from pyspark.sql import functions as F

from strata.plans import metrics


def test_rolling_mean_counts_calendar_days(spark):
    rows = [(date(2025, 1, 1), 10.0), (date(2025, 1, 2), 20.0), (date(2025, 1, 10), 60.0)]
    df = spark.createDataFrame([("t", *r) for r in rows], "t string, day date, s double")
    found = metrics.rolling_mean(df, ["t"], "day", "s", 9, "mean").orderBy("day").collect()
    assert [r["mean"] for r in found] == [10.0, 15.0, 40.0]


def test_day_before_needs_to_be_the_day_before(spark):
    starts = [datetime(2025, 1, 1, 5), datetime(2025, 1, 2, 5), datetime(2025, 1, 2, 6), datetime(2025, 1, 4, 1)]
    runs = spark.createDataFrame([("m", s) for s in starts], "mode string, start_time timestamp_ntz")
    found = metrics.runs_per_day(runs, ["mode"]).orderBy("day").collect()
    assert [(r.runs, r.runs_day_before) for r in found] == [(1, 0), (2, 1), (1, 0)]


def test_completeness_and_empty_groups(spark):
    df = spark.createDataFrame([("x", 1, None), ("x", None, None)], "g string, a int, b int")
    found = {r.column_name: r.completeness_pct for r in metrics.completeness(df, ["a", "b"], ["g"]).collect()}
    assert found == {"a": 50.0, "b": 0.0}
    assert metrics.completeness(df.filter("false"), ["a"], ["g"]).count() == 0


def test_missing_dates(spark):
    df = spark.createDataFrame([("x", date(2025, 1, d)) for d in (1, 2, 5)] + [("y", date(2025, 1, 9))], "g string, d date")
    found = metrics.missing_dates(df, F.col("d"), ["g"]).collect()
    assert sorted((r.g, r.day.day) for r in found) == [("x", 3), ("x", 4)]


def test_growth_from_zero_has_no_answer(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 5), ("a", 3, 10)], "g string, m int, n int")
    found = metrics.growth(df, ["g"], "m", "n").orderBy("m").collect()
    assert [r.growth_pct for r in found] == [None, None, 100.0]
    ways = metrics.trend(df, ["g"], "m", "n").orderBy("m").collect()
    assert [r.trend_direction for r in ways] == [None, "up", "up"]
