from datetime import date

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import QualityFailure, Rule
from strata.sources import landing
from strata.streaming import flows

SCHEMA = "k string, business_date date, processing_time long, v string"


def deliver(spark, place, *rows):
    df = spark.createDataFrame([(k, date(2025, 1, d), p, v) for k, d, p, v in rows], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(place)


def stream(spark, place):
    return flows.read_folder(spark, place, spark.createDataFrame([], SCHEMA).schema, 1)


def test_restart_reads_only_what_is_new(spark, tmp_path):
    place, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    deliver(spark, place, ("a", 1, 1, "x"))
    flows.flow(stream(spark, place), state, out, lambda df: df)
    flows.flow(stream(spark, place), state, out, lambda df: df)
    assert flows.read_batches(spark, out).count() == 1
    deliver(spark, place, ("b", 1, 2, "y"))
    flows.flow(stream(spark, place), state, out, lambda df: df)
    assert flows.read_batches(spark, out).count() == 2


def test_replayed_batch_leaves_one_copy(spark, tmp_path):
    df = spark.createDataFrame([("a", date(2025, 1, 1), 1, "x")], SCHEMA)
    for _ in range(2):
        flows.write_batch(df, str(tmp_path / "out"), 7)
    assert flows.read_batches(spark, str(tmp_path / "out")).count() == 1


def test_late_rows_never_win_in_type_1(spark, tmp_path):
    place, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    deliver(spark, place, ("a", 5, 1, "new"), ("b", 1, 1, "old"))
    flows.follow_latest(stream(spark, place), state, out, ["k"], "business_date", "processing_time")
    deliver(spark, place, ("a", 3, 9, "late"), ("b", 2, 2, "new"))
    flows.follow_latest(stream(spark, place), state, out, ["k"], "business_date", "processing_time")
    latest = flows.latest_state(spark, out, ["k"], "business_date", "processing_time")
    assert {r.k: r.v for r in latest.collect()} == {"a": "new", "b": "new"}


def test_late_and_repeated_rows_in_type_2(spark, tmp_path):
    place, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    deliver(spark, place, ("a", 1, 1, "x"), ("a", 5, 2, "y"))
    flows.follow_changes(stream(spark, place), state, out)
    deliver(spark, place, ("a", 3, 3, "late"), ("a", 5, 2, "y"))
    flows.follow_changes(stream(spark, place), state, out)
    found = flows.history_state(spark, out, ["k"], "business_date", "processing_time")
    got = sorted((r.start_at.day, r.end_at.day if r.end_at else None, r.v) for r in found.collect())
    assert got == [(1, 3, "x"), (3, 5, "late"), (5, None, "y")]


def test_fail_rule_stops_before_any_write(spark, tmp_path):
    place, state, out, audit = (str(tmp_path / n) for n in ("in", "state", "out", "audit"))
    deliver(spark, place, ("a", 1, 1, "x"), (None, 1, 2, "y"))
    rules = [Rule("FAIL", "k is null"), Rule("WARN", "v = 'x'")]
    with pytest.raises(Exception, match=f"{QualityFailure.__name__}|k is null: 1 rows"):
        flows.refine(stream(spark, place), state, lambda df: df, rules, lambda df: df, out, audit, ("d", "t", "v"))
    assert not (tmp_path / "out").exists() and not (tmp_path / "audit").exists()
    # the corrected delivery replaces the bad file, and the next run goes on
    good = spark.createDataFrame([("a", date(2025, 1, 1), 3, "x")], SCHEMA)
    good.coalesce(1).write.mode("overwrite").parquet(place)
    flows.refine(stream(spark, place), state, lambda df: df, rules, lambda df: df, out, audit, ("d", "t", "v"))
    assert flows.read_batches(spark, out).count() == flows.read_batches(spark, audit).count() == 1


def test_clean_and_audit_add_up(spark, tmp_path):
    place, state, out, audit = (str(tmp_path / n) for n in ("in", "state", "out", "audit"))
    deliver(spark, place, ("a", 1, 1, "x"), ("b", 1, 2, "y"))
    deliver(spark, place, ("c", 2, 3, "x"), ("d", 2, 4, None))
    rules = [Rule("QUARANTINE", "v = 'x'")]
    flows.refine(stream(spark, place), state, lambda df: df, rules, lambda df: df, out, audit, ("d", "t", "v"))
    assert {r.k for r in flows.read_batches(spark, out).collect()} == {"b", "d"}
    records = flows.read_batches(spark, audit)
    assert records.count() == 2 and records.select(F.sum("processing_time")).first()[0] == 4


def test_history_rewrites_touched_buckets_only(spark, tmp_path):
    place, state, log, table = (str(tmp_path / n) for n in ("in", "state", "log", "table"))

    def run():
        options = (["k"], "business_date", "processing_time", lambda v: v)
        flows.follow_history(stream(spark, place), state, log, table, *options, buckets=64)

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "table").glob("bucket=*/*.parquet")}

    deliver(spark, place, *[(k, 1, 1, "x") for k in "abcdefgh"], ("a", 5, 2, "y"))
    run()
    before = files()
    deliver(spark, place, ("a", 3, 3, "late"), ("a", 5, 2, "y"))
    run()
    kept = {p for p in before if files().get(p) == before[p]}
    assert len(before) - len(kept) == 1
    found = flows.read_history(spark, table)
    assert found.count() == 10
    got = sorted((r.start_at.day, r.end_at.day if r.end_at else None) for r in found.filter("k = 'a'").collect())
    assert got == [(1, 3), (3, 5), (5, None)]


def parts(spark, place, number):
    """A date of as many files, landed at once."""
    rows = [(f"k{i}", date(2025, 1, 1), i, "x") for i in range(30 * number)]
    landing.keep_record(spark, place)
    df = spark.createDataFrame(rows, SCHEMA).repartition(number)
    df.write.mode("append").partitionBy("business_date").parquet(place)


def interrupted(spark, place, state):
    """A batch that has taken its files and fails before it writes."""

    def fail(df, batch):
        raise RuntimeError("stopped")

    reader = flows.read_folder(spark, place, spark.createDataFrame([], SCHEMA).schema)
    with pytest.raises(Exception, match="stopped"):
        flows.drain(reader, state, fail)
    return reader


FLOWS = {
    "flow": lambda s, state, out: flows.flow(s, state, out, lambda df: df),
    "refine": lambda s, state, out: flows.refine(s, state, lambda df: df, [], lambda df: df, out, out + "-audit", ("d", "t", "v")),
    "latest": lambda s, state, out: flows.follow_latest(s, state, out, ["k"], "business_date", "processing_time"),
    "changes": lambda s, state, out: flows.follow_changes(s, state, out),
    "history": lambda s, state, out: flows.follow_history(
        s, state, out + "-log", out, ["k"], "business_date", "processing_time", lambda v: v, buckets=4),
}


@pytest.mark.parametrize("name", FLOWS)
def test_a_lost_part_of_a_date_fails_every_flow(spark, tmp_path, name):
    place, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    parts(spark, place, 3)
    stream_ = interrupted(spark, place, state)
    first = sorted((tmp_path / "in" / "business_date=2025-01-01").glob("*.parquet"))[0]
    first.unlink()
    with pytest.raises(Exception, match="gone without a replacement"):
        FLOWS[name](stream_, state, out)
    assert not (tmp_path / "out").exists()


def test_a_reload_replaces_its_dates_only(spark, tmp_path):
    place, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    parts(spark, place, 3)
    other = spark.createDataFrame([("o", date(2025, 1, 2), 1, "x")], SCHEMA)
    landing.append(other, place)
    stream_ = interrupted(spark, place, state)
    # a lost part is made good by a reload of its date
    sorted((tmp_path / "in" / "business_date=2025-01-01").glob("*.parquet"))[0].unlink()
    landing.replace_dates(spark.createDataFrame([("n", date(2025, 1, 1), 9, "y")], SCHEMA), place)
    flows.flow(stream_, state, out, lambda df: df)
    assert {r.k for r in flows.read_batches(spark, out).collect()} == {"n", "o"}
    # a part of a date that was not reloaded is still missed, also beside a later part
    landing.append(other, place)
    flows_state = str(tmp_path / "state2")
    stream_ = interrupted(spark, place, flows_state)
    sorted((tmp_path / "in" / "business_date=2025-01-02").glob("*.parquet"))[0].unlink()
    with pytest.raises(Exception, match="gone without a replacement"):
        flows.flow(stream_, flows_state, out + "2", lambda df: df)


def test_files_of_a_batch_are_known_beyond_compaction(spark, tmp_path):
    place, state, out = (str(tmp_path / n) for n in ("in", "state", "out"))
    for i in range(12):
        deliver(spark, place, (f"k{i}", 1, i, "x"))
    flows.flow(stream(spark, place), state, out, lambda df: df)
    assert flows.read_batches(spark, out).count() == 12
    known = [n for b in range(12) for n, _ in flows.batch_files(spark, state, b)]
    assert len(known) == len(set(known)) == 12
