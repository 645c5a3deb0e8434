from datetime import date
from itertools import permutations

from pyspark.sql import functions as F

from strata.operators.cdc import snapshot_deletes, snapshot_diff, without_operations
from strata.operators.scd import active_flag, present_scd2, scd1, scd2
from strata.functions.labels import deleted_flag

FEED = "k string, business_date date, processing_time long, v string, Row_Is_Deleted_Ind string"


def d(day):
    return date(2025, 1, day)


def feed(spark, *rows):
    return spark.createDataFrame([("a", d(x), p, v, g) for x, p, v, g in rows], FEED)


def versions(df, **options):
    found = present_scd2(scd2(df, ["k"], "business_date", **options))
    return sorted(
        (r.Row_Effective_Date, r.Row_Term_Date, r.v, r.Row_Is_Active_Ind, r.is_current) for r in found.collect()
    )


END = date(9999, 12, 31)


def test_late_row_splits_a_version_in_any_arrival_order(spark):
    rows = [(1, 10, "x", "N"), (3, 11, "y", "N"), (2, 12, "z", "N")]
    want = [(d(1), d(2), "x", "Y", False), (d(2), d(3), "z", "Y", False), (d(3), END, "y", "Y", True)]
    for order in permutations(rows):
        assert versions(feed(spark, *order)) == want


def test_same_day_gives_a_version_without_length(spark):
    df = feed(spark, (1, 10, "x", "N"), (1, 11, "y", "N"), (2, 12, "z", "N"))
    assert versions(df) == [
        (d(1), d(1), "x", "N", False),
        (d(1), d(2), "y", "Y", False),
        (d(2), END, "z", "Y", True),
    ]
    assert scd1(df, ["k"], "business_date").first().v == "z"


def test_delete_and_reinsert(spark):
    df = feed(spark, (1, 10, "x", "N"), (2, 11, "x", "Y"), (4, 12, "x", "N"))
    assert versions(df) == [
        (d(1), d(2), "x", "Y", False),
        (d(2), d(2), "x", "Y", False),
        (d(4), END, "x", "Y", True),
    ]


def test_trailing_delete_is_not_current(spark):
    assert versions(feed(spark, (1, 10, "x", "N"), (2, 11, "x", "Y")))[-1] == (d(2), d(2), "x", "Y", False)


def test_ties_have_one_winner_whatever_the_order(spark):
    rows = [(1, 10, "x", "N"), (1, 10, "y", "N"), (1, 10, "z", "N")]
    firsts = {scd1(feed(spark, *o), ["k"], "business_date").first().v for o in permutations(rows)}
    seconds = {tuple(versions(feed(spark, *o))) for o in permutations(rows)}
    assert len(firsts) == 1 and len(seconds) == 1 and len(next(iter(seconds))) == 1


def test_tracked_columns_suppress_unchanged_versions(spark):
    df = feed(spark, (1, 10, "x", "N"), (2, 11, "x", "N"), (3, 12, None, "N"), (4, 13, None, "N"), (5, 14, "x", "N"))
    got = [(a, b, v) for a, b, v, _, _ in versions(df, track=["v"])]
    assert got == [(d(1), d(3), "x"), (d(3), d(5), None), (d(5), END, "x")]


def test_versions_do_not_overlap_and_one_is_open(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("k"),
        F.expr("date_add(date'2025-01-01', int(hash(id) % 60))").alias("business_date"),
        F.col("id").alias("processing_time"),
        F.lit("N").alias("Row_Is_Deleted_Ind"),
    )
    found = present_scd2(scd2(df, ["k"], "business_date", unique=True)).collect()
    assert len(found) == 3000
    by_key = {}
    for r in found:
        by_key.setdefault(r.k, []).append((r.business_date, r.processing_time, r.Row_Term_Date))
    for rows in by_key.values():
        rows.sort()
        assert [r[2] for r in rows] == [r[0] for r in rows[1:]] + [END]


def test_excluded_columns_leave_the_target(spark):
    df = feed(spark, (1, 10, "x", "N"))
    assert "v" not in scd1(df, ["k"], "business_date", exclude=["v"]).columns
    assert "v" not in scd2(df, ["k"], "business_date", exclude=["v"]).columns


def test_active_flag_shares_ties(spark):
    df = feed(spark, (1, 10, "x", "N"), (1, 11, "y", "N"), (1, 11, "z", "N"), (2, 5, "w", "N"))
    got = {r.v: r.Row_Is_Active_Ind for r in active_flag(df, ["k"], F.col("business_date")).collect()}
    assert got == {"x": "N", "y": "Y", "z": "Y", "w": "Y"}


LAND = "k string, v int, business_date date, `__$operation` string"


def snapshot(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v int")


def stamped(df, day):
    return df.withColumn("business_date", F.lit(d(day)))


def test_deletes_are_found_once(spark):
    first = snapshot_deletes(snapshot(spark, ("a", 1), ("b", 2), ("c", 3), (None, 4)), None, ["k"])
    landing = stamped(first, 1)
    second = snapshot_deletes(snapshot(spark, ("b", 2), ("c", 9), ("d", 5), (None, 4)), landing, ["k"])
    codes = {(r.k, r["__$operation"]) for r in second.collect()}
    assert codes == {("a", "1"), ("b", "5"), ("c", "5"), ("d", "5"), (None, "5")}
    landing = landing.unionByName(stamped(second.select("k", "v", "`__$operation`"), 2))
    third = snapshot_deletes(snapshot(spark, ("b", 2)), landing, ["k"])
    assert sorted(r.k or "" for r in third.filter("`__$operation` = '1'").collect()) == ["", "c", "d"]


def test_snapshot_diff_classes(spark):
    old = snapshot(spark, ("a", 1), ("b", 2), ("c", 3), ("n", None))
    new = snapshot(spark, ("b", 2), ("c", 9), ("d", 5), ("n", None))
    got = {r.k: (r.change, r.v) for r in snapshot_diff(old, new, ["k"]).collect()}
    assert got == {"a": ("D", 1), "b": ("N", 2), "c": ("U", 9), "d": ("I", 5), "n": ("N", None)}


def test_operation_codes(spark):
    df = spark.createDataFrame([("1",), ("2",), ("4",), ("5",), ("D",), (None,)], "`__$operation` string")
    code = F.col("`__$operation`")
    got = df.select(code, deleted_flag(code, "1").alias("a"), deleted_flag(code, "D").alias("b")).collect()
    assert [r[0] for r in got if r.a == "Y"] == ["1"] and [r[0] for r in got if r.b == "Y"] == ["D"]
    assert without_operations(df, ["2", "4"]).count() == 4


def test_deletes_sort_only_the_keys_that_are_gone(spark):
    landing = stamped(snapshot_deletes(snapshot(spark, ("a", 1), ("b", 2)), None, ["k"]), 1)
    found = snapshot_deletes(snapshot(spark, ("b", 2)), landing, ["k"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("LeftAnti")  # the join feeds the window
