"""Maintained tables against the same changes in one batch."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from strata.operators.scd import scd1, scd2
from strata.sources import maintained as m

SCHEMA = "k string, business_date date, processing_time long, v string"
COLUMNS = ["k", "business_date", "processing_time", "v"]


def frame(spark, rows):
    return spark.createDataFrame([(k, date(2025, 1, 1) + timedelta(d), p, v) for k, d, p, v in rows], SCHEMA)


def table(root, history, **options):
    return m.Maintained(str(root), ["k"], "business_date", history=history, **options)


def same(spark, kept, rows):
    changes = frame(spark, rows)
    if kept.history:
        want, columns = scd2(changes, ["k"], "business_date"), [*COLUMNS, "start_at", "end_at"]
    else:
        want, columns = scd1(changes, ["k"], "business_date"), COLUMNS
    got = m.current(spark, kept).select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*columns).collect()))


@pytest.mark.parametrize("history", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_one_batch(spark, tmp_path, history, seed):
    rng = random.Random(seed)
    kept = table(tmp_path / "t", history, many=3, fold=1.5)
    rows = []
    for batch in range(7):
        new = [
            (rng.choice(["a", "b", "c", None, "hot", "hot"]), rng.randint(0, 12), rng.randint(0, 3), rng.choice("xyz"))
            for _ in range(rng.choice([0, 3, 12]))
        ]
        rows += new
        m.apply_changes(kept, frame(spark, new), "feed", batch)
        same(spark, kept, rows)
    m.compact(spark, kept)
    same(spark, kept, rows)


def test_a_batch_counts_once(spark, tmp_path):
    kept = table(tmp_path / "t", True)
    first = [("a", 1, 1, "x"), ("b", 1, 1, "x")]
    m.apply_changes(kept, frame(spark, first), "one", 0)
    before = m.commits(spark, kept)
    m.apply_changes(kept, frame(spark, [("a", 2, 2, "never")]), "one", 0)
    assert m.commits(spark, kept) == before
    m.apply_changes(kept, frame(spark, [("a", 3, 1, "y")]), "other", 0)
    same(spark, kept, [*first, ("a", 3, 1, "y")])


def test_a_run_that_failed_before_its_commit_leaves_nothing(spark, tmp_path, monkeypatch):
    kept = table(tmp_path / "t", True)
    m.apply_changes(kept, frame(spark, [("a", 1, 1, "x")]), "one", 0)
    with monkeypatch.context() as patch:
        patch.setattr(m, "publish_text", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            m.apply_changes(kept, frame(spark, [("a", 2, 1, "wrong")]), "one", 1)
    same(spark, kept, [("a", 1, 1, "x")])
    m.apply_changes(kept, frame(spark, [("a", 2, 1, "right")]), "one", 1)
    same(spark, kept, [("a", 1, 1, "x"), ("a", 2, 1, "right")])


def test_a_large_batch_goes_into_the_base_at_once(spark, tmp_path):
    kept = table(tmp_path / "t", False)
    first = [(f"k{i}", 1, 1, "x") for i in range(40)]
    commit = m.apply_changes(kept, frame(spark, first), "one", 0)
    # nothing was there to be folded with, so the rows are written once
    assert commit.base == "delta-1" and commit.base_rows == 40 and not commit.deltas
    later = [(f"k{i}", d, 2, "y") for i in range(30, 60) for d in (0, 2)]
    commit = m.apply_changes(kept, frame(spark, later), "one", 1, len(later))
    assert commit.base == f"base-{commit.number}" and commit.base_rows == 60 and not commit.deltas
    assert not (tmp_path / "t" / f"delta-{commit.number}").exists()
    same(spark, kept, [*first, *later])
    assert m.apply_changes(kept, frame(spark, later), "one", 1, len(later)) == commit
    few = [("k1", 3, 3, "z"), ("k1", 0, 3, "never"), ("new", 3, 3, "z")]
    commit = m.apply_changes(kept, frame(spark, few), "one", 2, len(few))
    assert len(commit.deltas) == 1 and commit.delta_rows == 2
    same(spark, kept, [*first, *later, *few])


def test_deltas_hold_what_changes_touch(spark, tmp_path):
    kept = table(tmp_path / "t", True)
    many = [(f"k{i}", d, 1, "x") for i in range(200) for d in (1, 5, 9)]
    commit = m.apply_changes(kept, frame(spark, many), "one", 0)
    assert commit.base_rows == 600 and not commit.deltas
    # a new version at the end, and one in the middle of another key's history
    commit = m.apply_changes(kept, frame(spark, [("k1", 12, 1, "y"), ("k2", 3, 1, "y")]), "one", 1)
    assert len(commit.deltas) == 1 and commit.delta_rows == 4 and commit.base_rows == 600
    same(spark, kept, [*many, ("k1", 12, 1, "y"), ("k2", 3, 1, "y")])


def test_reading_prunes_ended_versions(spark, tmp_path):
    kept = table(tmp_path / "t", True)
    m.apply_changes(kept, frame(spark, [("a", d, 1, "x") for d in range(50)]), "one", 0)
    known = m.read_commit(spark, kept)
    late = m._current(spark, kept, known, date(2025, 1, 1) + timedelta(48))
    assert late.count() == 3
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert f"{m.OPEN}" in plan and f"GreaterThanOrEqual({m.END}" in plan


def test_new_columns_and_other_types(spark, tmp_path):
    kept = table(tmp_path / "t", True)
    first = [("a", 1, 1, "x")]
    m.apply_changes(kept, frame(spark, first), "one", 0)
    m.apply_changes(kept, frame(spark, [("a", 2, 1, "y")]).withColumn("more", F.lit(7)), "one", 1)
    assert sorted((r.v, r.more) for r in m.current(spark, kept).collect()) == [("x", None), ("y", 7)]
    with pytest.raises(TypeError, match="more is int, not string"):
        m.apply_changes(kept, frame(spark, first).withColumn("more", F.lit("7")), "one", 2)


def test_earlier_commits_stay_readable_until_they_expire(spark, tmp_path):
    kept = table(tmp_path / "t", False, fold=0)
    for batch in range(4):
        m.apply_changes(kept, frame(spark, [("a", batch, 1, str(batch))]), "one", batch)
    known = m.commits(spark, kept)
    assert [r.v for r in m.current(spark, kept, known[1]).collect()] == ["0"]
    gone = m.expire(spark, kept, keep=1)
    assert gone and m.commits(spark, kept) == known[-1:]
    assert [r.v for r in m.current(spark, kept).collect()] == ["3"]
    with pytest.raises(LookupError):
        m.current(spark, kept, known[0])
    with pytest.raises(LookupError):
        m.current(spark, table(tmp_path / "none", False))
