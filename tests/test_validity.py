from datetime import date

import pytest
from pyspark.sql import functions as F

from strata.operators.temporal import (
    Intervals,
    align,
    align_latest,
    islands,
    slices,
    timeline,
    trim,
)

END = date(9999, 12, 31)


def m(month, day=1):
    return date(2025, month, day)


def intervals(spark, *rows, value="v"):
    df = spark.createDataFrame([("a", *r) for r in rows], f"k string, s date, e date, {value} string")
    return Intervals(df, ["k"], "s", "e")


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_slices_cover_first_to_last_boundary(spark):
    states = intervals(spark, (m(1), m(3), "x"), (m(3), END, "y"))
    counts = intervals(spark, (m(1), m(2), "1"), (m(2), m(4), "2"), value="n")
    found = got(slices([states, counts]), "slice_start", "slice_end")
    assert found == [(m(1), m(2)), (m(2), m(3)), (m(3), m(4)), (m(4), END)]


def test_align_keeps_contained_slices_only(spark):
    states = intervals(spark, (m(1), m(3), "x"), (m(3), END, "y"), (m(2), m(2), "none"))
    counts = intervals(spark, (m(1), m(2), "1"), (m(2), m(4), "2"), value="n")
    sliced = slices([states, counts])
    want = [(m(1), m(2), "x", "1"), (m(2), m(3), "x", "2"), (m(3), m(4), "y", "2")]
    columns = ["slice_start", "slice_end", "v", "n"]
    assert got(align(sliced, [(states, ["v"]), (counts, ["n"])]), *columns) == want
    assert got(align_latest(align_latest(sliced, states, ["v"]), counts, ["n"]), *columns) == want
    assert got(timeline([(states, ["v"]), (counts, ["n"])]), *columns) == want


def test_align_with_overlaps_ancient_and_open_versions(spark):
    rows = [(date(1900, 1, 1), END, "old"), (m(1), m(6), "p"), (m(2), END, "q"), (date(3000, 1, 1), END, "far")]
    versions = intervals(spark, *rows)
    sliced = slices([versions])
    want = sorted(
        (r.slice_start, r.slice_end, v)
        for r in sliced.collect()
        for s, e, v in rows
        if s <= r.slice_start and r.slice_end <= e
    )
    for years in (1, 10, 200):
        assert got(align(sliced, [(versions, ["v"])], years=years), "slice_start", "slice_end", "v") == want


def test_overlapping_versions_are_refused(spark):
    versions = intervals(spark, (m(1), m(4), "x"), (m(2), m(5), "y"))
    twice = intervals(spark, (m(1), m(4), "x"), (m(1), m(5), "y"))
    for wrong in (versions, twice):
        with pytest.raises(Exception, match="versions of k overlap"):
            timeline([(wrong, ["v"])]).collect()
        with pytest.raises(Exception, match="versions of k overlap"):
            align_latest(slices([wrong]), wrong, ["v"]).collect()


def test_left_variant_keeps_slices_without_a_version(spark):
    states = intervals(spark, (m(1), m(3), "x"))
    counts = intervals(spark, (m(2), m(3), "1"), value="n")
    found = align(slices([states, counts]), [(counts, ["n"])], outer=True)
    assert got(found, "slice_start", "n") == [(m(1), None), (m(2), "1")]


def states_of(spark, *rows):
    return spark.createDataFrame([("a", *r) for r in rows], "k string, s date, e date, v string")


def test_alternating_states(spark):
    df = states_of(spark, (m(1), m(2), "A"), (m(2), m(3), "B"), (m(3), m(4), "A"), (m(4), m(5), "B"))
    days = df.withColumns({c: F.expr(f"date_add(date'2025-01-01', month({c}))") for c in ("s", "e")})
    j = lambda n: date(2025, 1, 1 + n)
    own = trim(islands(days, ["k"], ["v"], "s", "e"), ["k"], "s", "e")
    assert got(own, "s", "e", "v") == [(j(1), j(1), "A"), (j(2), j(2), "B"), (j(3), j(3), "A"), (j(4), j(5), "B")]
    other = trim(islands(days, ["k"], ["v"], "s", "e", mode="reference"), ["k"], "s", "e")
    assert got(other, "s", "e", "v") == [(j(1), j(1), "A"), (j(2), j(2), "B"), (j(3), j(4), "A")]


@pytest.mark.parametrize("gap,merged", [(0, {"state": 1, "reference": 1}), (1, {"state": 2, "reference": 1}), (2, {"state": 2, "reference": 2})])
def test_gaps(spark, gap, merged):
    df = states_of(spark, (m(1), m(1, 10), "A"), (m(1, 10 + gap), m(2), "A"))
    for mode, count in merged.items():
        assert islands(df, ["k"], ["v"], "s", "e", mode=mode).count() == count


def test_nulls_are_one_state_and_null_places_are_not(spark):
    df = states_of(spark, (m(1), m(2), None), (m(2), m(3), None))
    assert islands(df, ["k"], ["v"], "s", "e").count() == 1
    two = spark.createDataFrame(
        [("a", m(1), m(2), "x", None), ("a", m(2), m(3), None, "x"), ("a", m(3), m(4), "x", None)],
        "k string, s date, e date, v string, w string",
    )
    assert islands(two, ["k"], ["v", "w"], "s", "e").count() == 3


def test_parallel_timelines_both_survive(spark):
    df = states_of(spark, (m(1), m(3), "A"), (m(1), m(3), "B"), (m(3), END, "A"), (m(3), END, "B"))
    kept = trim(df, ["k"], "s", "e", parallel=["v"])
    assert got(kept, "s", "e", "v") == [
        (m(1), m(2, 28), "A"), (m(1), m(2, 28), "B"), (m(3), END, "A"), (m(3), END, "B"),
    ]
    assert trim(df, ["k"], "s", "e").count() < 4


def test_published_intervals_never_overlap(spark, data):
    from strata.queries.validity import gold_dimension

    by_key = {}
    for r in gold_dimension(spark, data).collect():
        by_key.setdefault(r.k, []).append((r.eff, r.term))
    for found in by_key.values():
        found.sort()
        assert all(a <= b for a, b in found)
        assert all(first[1] < second[0] for first, second in zip(found, found[1:]))


def test_empty_input(spark):
    none = intervals(spark).frame.filter("false")
    versions = Intervals(none, ["k"], "s", "e")
    assert slices([versions]).count() == 0
    assert align(slices([versions]), [(versions, ["v"])]).count() == 0
    assert timeline([(versions, ["v"])]).count() == 0
    assert trim(islands(none, ["k"], ["v"], "s", "e"), ["k"], "s", "e").count() == 0
