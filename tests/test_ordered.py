"""Hierarchical look-ups against a plain scan in Python."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.ordered import block, fingerprint, latest_per_key, nearest


def _brute(rows, after, inclusive):
    found = {}
    for key, day, at, value in rows:
        near = [
            ((d, a), v)
            for k, d, a, v in rows
            if k == key
            and v is not None
            and ((d, a) == (day, at) and inclusive or (((d, a) > (day, at)) if after else ((d, a) < (day, at))))
        ]
        pick = min(near) if after and near else max(near) if near else (None, None)
        found[(key, day, at)] = pick[1]
    return found


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_nearest_equals_scan(spark, after, inclusive):
    source = random.Random(7)
    rows = set()
    for _ in range(400):
        # key 0 holds most rows; positions cross 65,536-wide blocks
        key = source.choice([0, 0, 0, 1, 2, None])
        rows.add((key, source.randint(1, 6), source.randint(0, 5) * 40_000))
    rows = [(*r, source.choice([None, source.randint(1, 99)])) for r in sorted(rows, key=str)]
    df = spark.createDataFrame(rows, "key int, day int, at long, v int").withColumn("b", block("at"))
    found = nearest(df, ["key"], ["day", "b", "at"], F.col("v"), "near", after=after, inclusive=inclusive)
    got = {(r.key, r.day, r.at): r.near for r in found.collect()}
    assert got == _brute(rows, after, inclusive)


def test_nearest_carries_null_in_a_struct(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5)], "k int, at int, v int")
    found = nearest(df, ["k"], ["at"], F.struct("v"), "before").orderBy("at").collect()
    assert found[0].before is None and found[1].before.v is None and found[1].before is not None


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    best = latest_per_key(df, ["k"], [F.col("id").desc()])
    assert sorted(r.id for r in best.collect()) == [997, 998, 999]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_fingerprint_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    hashes = df.select(fingerprint([F.col("a"), F.col("b")]).alias("h")).collect()
    assert hashes[0].h != hashes[1].h
