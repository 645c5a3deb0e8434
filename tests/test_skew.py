"""One key holds a third of all rows: no task may hold that key."""

import pytest
from pyspark.sql import functions as F

from strata.operators.ordered import latest_per_key
from strata.operators.scd import active_flag, scd2
from strata.operators.temporal import Intervals, timeline

ROWS = 300_000
HOT = ROWS // 3


@pytest.fixture(scope="module")
def cluster(spark):
    """Planner settings scaled to the test data as a cluster's are to its own."""
    session = spark.newSession()
    for key, value in {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "300KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }.items():
        session.conf.set(key, value)
    return session


@pytest.fixture(scope="module")
def feed(cluster, tmp_path_factory):
    """Key 0 has a third of all rows; half of those fall on one day."""
    place = str(tmp_path_factory.mktemp("skew") / "feed")
    number = F.col("id")
    hot = number % 3 == 0
    same_day = hot & (number % 2 == 0)
    cluster.range(ROWS).select(
        F.when(hot, 0).otherwise(1 + F.pmod(F.hash("id"), F.lit(5000))).alias("k"),
        F.when(same_day, F.lit("2024-03-01").cast("date"))
        .otherwise(F.expr("date_add(date'2024-01-01', int(pmod(hash(id, 1), 300)))"))
        .alias("business_date"),
        number.alias("processing_time"),
        (number % 7).cast("string").alias("v"),
        F.md5(number.cast("string")).alias("payload"),
    ).repartition(16).write.parquet(place)
    return cluster.read.parquet(place)


def largest_task(df):
    """Most rows any task of the last stage produces, with every column in use."""
    kept = [F.max(F.col(c)).alias(f"m_{c}") for c in df.columns]
    per_task = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), *kept)
    return max(r.n for r in per_task.collect())


def test_history_spreads_a_hot_key_and_a_hot_day(feed):
    versions = scd2(feed, ["k"], "business_date", unique=True)
    assert versions.count() == ROWS
    assert largest_task(versions) < HOT // 3
    ends = versions.filter("k = 0").select(F.count_if(F.col("end_at").isNull())).first()[0]
    assert ends == 1


def test_active_flag_spreads(feed):
    flagged = active_flag(feed, ["k"], F.col("business_date"))
    assert flagged.count() == ROWS and largest_task(flagged) < HOT // 3


def test_latest_sends_one_row_per_key_and_task(feed):
    best = latest_per_key(feed, ["k"], [F.col("processing_time").desc()])
    assert best.filter("k = 0").first().processing_time == ROWS - ROWS % 3 - 3 * (ROWS % 3 == 0)
    assert largest_task(best) < 1000


def test_timeline_rows_of_a_key_are_bounded_by_the_calendar(feed):
    versions = scd2(feed, ["k"], "business_date", unique=True)
    end = F.coalesce("end_at", F.lit("9999-12-31").cast("date"))
    held = Intervals(versions.withColumn("end_at", end), ["k"], "start_at", "end_at")
    rows = timeline([(held, ["v"])])
    assert rows.filter("k = 0").count() <= 300


def test_tracked_history_of_a_hot_key(feed):
    kept = scd2(feed, ["k"], "business_date", track=["v"], unique=True)
    rows = (
        feed.filter("k = 0").orderBy("business_date", "processing_time").select("v").toPandas()["v"]
    )
    assert kept.filter("k = 0").count() == int((rows != rows.shift()).sum())
