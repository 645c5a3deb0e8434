"""Timelines against plain Python on random data, one key holding most of it."""

import random
from datetime import date, timedelta

import pytest

from strata.operators.temporal import Intervals, align, islands, slices, timeline, trim

DAY0 = date(2023, 1, 1)
END = date(9999, 12, 31)


def d(n):
    return END if n is None else DAY0 + timedelta(days=n)


def overlapping(source, count):
    rows = []
    for _ in range(count):
        key = source.choice([0, 0, 0, 1, 2])
        start = source.randint(0, 900)
        end = source.choice([None, start, start + source.randint(1, 500)])
        rows.append((key, d(start), d(end), source.choice(["x", "y", None])))
    return rows


def chained(source, count):
    """Versions of a key that follow each other, with gaps and one open end."""
    rows = []
    for key in range(3):
        at = source.randint(0, 30)
        for _ in range(count):
            end = at + source.randint(1, 40)
            rows.append((key, d(at), d(end), source.choice(["x", "y", None])))
            at = end + source.choice([0, 0, 1, 5])
        rows.append((key, d(at), END, "z"))
    return rows


def frame(spark, rows, value):
    df = spark.createDataFrame(rows, f"k int, s date, e date, {value} string")
    return Intervals(df, ["k"], "s", "e")


def brute_slices(*tables):
    points = {}
    for rows in tables:
        for k, s, e, _ in rows:
            points.setdefault(k, set()).update((s, e))
    return {(k, a, b) for k, p in points.items() for a, b in zip(sorted(p), sorted(p)[1:])}


def contained(cut, rows):
    return {(k, a, b, v) for k, a, b in cut for key, s, e, v in rows if key == k and s <= a and b <= e}


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_align_equals_all_pairs(spark, seed):
    rows = overlapping(random.Random(seed), 120)
    versions = frame(spark, rows, "v")
    cut = slices([versions])
    want = brute_slices(rows)
    assert set(tuples(cut, "k", "slice_start", "slice_end")) == want
    for years in (1, 10):
        found = align(cut, [(versions, ["v"])], years=years).distinct()
        assert tuples(found, "k", "slice_start", "slice_end", "v") == sorted(contained(want, rows), key=str)


@pytest.mark.parametrize("seed", [3, 4])
def test_timeline_equals_slices_and_align(spark, seed):
    source = random.Random(seed)
    a, b = frame(spark, chained(source, 25), "v"), frame(spark, chained(source, 10), "w")
    columns = ["k", "slice_start", "slice_end", "v", "w"]
    one = tuples(timeline([(a, ["v"]), (b, ["w"])]), *columns)
    assert one == tuples(align(slices([a, b]), [(a, ["v"]), (b, ["w"])]), *columns)


@pytest.mark.parametrize("seed", [5, 6])
def test_islands_cover_the_same_days_per_state(spark, seed):
    rows = chained(random.Random(seed), 40)
    merged = islands(frame(spark, rows, "v").frame, ["k"], ["v"], "s", "e")
    want = []
    for k, s, e, v in sorted(rows, key=lambda r: (r[0], str(r[3]), r[1])):
        if want and want[-1][0] == k and want[-1][3] == v and want[-1][2] == s:
            want[-1] = (k, want[-1][1], e, v)
        else:
            want.append((k, s, e, v))
    assert tuples(merged, "k", "s", "e", "v") == sorted(want, key=str)
    closed = tuples(trim(merged, ["k"], "s", "e"), "k", "s", "e")
    for key in range(3):
        own = sorted(r[1:] for r in closed if r[0] == key)
        assert all(x[1] < y[0] for x, y in zip(own, own[1:]))
