from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from strata.sources import landing
from strata.streaming.flows import flow, read_batches

A, B = date(2025, 4, 8), date(2025, 4, 9)


def write(spark, place, *rows, schema="k int, v string, business_date date"):
    landing.append(spark.createDataFrame(list(rows), schema), place)


def test_stamp(spark):
    raw = spark.createDataFrame([(1, "2025-04-09", 7)], "k int, `when` string, `__$start` int")
    row = landing.stamp(raw, "cdc", "2025-04-08")
    assert dict(row.dtypes)["__$start"] == "string"
    assert row.first().asDict() == {
        "k": 1, "when": "2025-04-09", "__$start": "7", "__$operation": "5", "source": "Not Used",
        "source_schema": "cdc", "business_date": A,
    }
    assert landing.stamp(raw, "cdc", "2025-04-08", "when").first().business_date == B
    coded = raw.withColumn("__$operation", F.lit(1))
    assert landing.stamp(coded, "cdc", "2025-04-08").first()["__$operation"] == "1"


def test_csv_has_a_header(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Group ID,Group Name\n1,x\n")
    assert landing.read_files(spark, str(tmp_path), "csv").first().asDict() == {"Group ID": "1", "Group Name": "x"}


def test_append_takes_new_columns(spark, tmp_path):
    place = str(tmp_path / "t")
    write(spark, place, (1, "a", A))
    write(spark, place, (2, "b", B, 5), schema="k int, v string, business_date date, n int")
    got = {r.k: (r.v, r.n, r.business_date) for r in landing.read_table(spark, place).collect()}
    assert got == {1: ("a", None, A), 2: ("b", 5, B)}


def files(place, day):
    return {p.name: p.read_bytes() for p in (place / f"business_date={day}").glob("*.parquet")}


def test_reload_leaves_other_dates_alone(spark, tmp_path):
    place = tmp_path / "t"
    write(spark, str(place), (1, "a", A), (2, "b", A), (3, "c", B))
    before, old = files(place, B), files(place, A)
    landing.replace_dates(spark.createDataFrame([(1, "z", A)], "k int, v string, business_date date"), str(place))
    assert files(place, B) == before and not set(files(place, A)) & set(old)
    assert sorted((r.k, r.v) for r in landing.read_table(spark, str(place)).collect()) == [(1, "z"), (3, "c")]


def test_row_correction_touches_its_date_only(spark, tmp_path):
    place = tmp_path / "t"
    write(spark, str(place), (1, "a", A), (2, "b", A), (1, "a", B))
    before = files(place, B)
    fixed = landing.read_table(spark, str(place)).filter(F.col("business_date") == A).filter("k = 1")
    landing.correct_rows(spark, str(place), fixed.withColumn("v", F.lit("new")), ["k"])
    assert files(place, B) == before
    got = sorted((r.k, r.v, r.business_date) for r in landing.read_table(spark, str(place)).collect())
    assert got == [(1, "a", B), (1, "new", A), (2, "b", A)]


def test_first_load_has_no_table(spark, tmp_path):
    assert landing.read_table_if_any(spark, str(tmp_path / "none")) is None


def test_load_computes_deletes_for_snapshots(spark, tmp_path):
    place = str(tmp_path / "t")

    def deliver(day, *keys, **options):
        rows = landing.stamp(spark.createDataFrame([(k, 1) for k in keys], "k int, n int"), "dbo", day)
        landing.load(spark, rows, place, ["k"], "incremental_run", day, compute_cdc=True, **options)

    deliver("2025-04-08", 1, 2)
    deliver("2025-04-09", 2, 3)
    deliver("2025-04-10", 2, 3)
    codes = sorted(
        (str(r.business_date), r.k, r["__$operation"]) for r in landing.read_table(spark, place).collect()
    )
    assert codes == [
        ("2025-04-08", 1, "5"), ("2025-04-08", 2, "5"),
        ("2025-04-09", 1, "1"), ("2025-04-09", 2, "5"), ("2025-04-09", 3, "5"),
        ("2025-04-10", 2, "5"), ("2025-04-10", 3, "5"),
    ]
    deliver("2025-04-11", 9, refresh="full_refresh")
    assert {r.k for r in landing.read_table(spark, place).filter("`__$operation` = '5'").collect()} == {9}


def test_a_key_that_comes_and_goes_on_one_date(spark, tmp_path):
    place = str(tmp_path / "t")

    def deliver(day, *keys, **options):
        rows = landing.stamp(spark.createDataFrame([(k, 1) for k in keys], "k int, n int"), "dbo", day)
        landing.load(spark, rows, place, ["k"], "incremental_run", day, compute_cdc=True, **options)

    many = range(200)
    deliver("2025-04-08", 1000, *many)
    deliver("2025-04-08", 1000)  # all but one are gone, on the same date
    deliver("2025-04-09", 1000)
    deliver("2025-04-09", 1000, *range(50))  # some come back, on the same date
    deliver("2025-04-10", 1000)
    rows = landing.read_table(spark, place).filter("k < 1000").groupBy("k", "`__$operation`").count().collect()
    codes = {(r.k, r["__$operation"]): r["count"] for r in rows}
    for k in many:
        assert codes[k, "1"] == (2 if k < 50 else 1)


def test_a_corrected_file_replaces_its_date_even_when_it_is_empty(spark, tmp_path):
    place = str(tmp_path / "t")

    def stamped(day, *keys):
        return landing.stamp(spark.createDataFrame([(k, 1) for k in keys], "k int, n int"), "dbo", day)

    def load(rows, day, **options):
        landing.load(spark, rows, place, ["k"], "apply_correction", day, **options)

    load(stamped("2025-04-08", 1, 2), "2025-04-08")
    load(stamped("2025-04-09", 3), "2025-04-09")
    load(stamped("2025-04-08", 5), "2025-04-08", correction="file_correction")
    shown = lambda: sorted((str(r.business_date), r.k) for r in landing.read_table(spark, place).collect())
    assert shown() == [("2025-04-08", 5), ("2025-04-09", 3)]
    load(stamped("2025-04-08"), "2025-04-08", correction="file_correction")
    assert shown() == [("2025-04-09", 3)]


def test_dated_folders_are_pruned(spark, tmp_path):
    for day in ("20250408", "20250409", "20250410"):
        spark.createDataFrame([(day,)], "d string").write.parquet(f"{tmp_path}/BusinessStartDate={day}/orders")
    found = landing.read_dates(spark, str(tmp_path), "20250409", "20250410", "orders")
    assert sorted(r.d for r in found.collect()) == ["20250409", "20250410"]
    assert "PartitionFilters: [isnotnull(BusinessStartDate" in found._jdf.queryExecution().executedPlan().toString()


def test_malformed_lines_are_kept(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"k": 1}\n{"k": oops}\n')
    want = StructType([StructField("k", IntegerType())])
    found = landing.read_files(spark, str(tmp_path), "json", want, "bad").collect()
    assert sorted((r.k or 0, r.bad) for r in found) == [(0, '{"k": oops}'), (1, None)]


def test_named_tables(spark, tmp_path):
    spark.range(5).write.option("path", str(tmp_path / "t")).saveAsTable("named_numbers")
    assert landing.open_named(spark, "named_numbers").count() == 5
    stream = landing.open_named(spark, "named_numbers", stream=True)
    flow(stream, str(tmp_path / "state"), str(tmp_path / "out"), lambda df: df)
    assert read_batches(spark, str(tmp_path / "out")).count() == 5
    spark.sql("DROP TABLE named_numbers")


def test_deletes_belong_to_the_schema_of_their_run(spark, tmp_path):
    place = str(tmp_path / "t")

    def load(keys, schema, day, scenario):
        raw = spark.createDataFrame([(k, "x") for k in keys], "k int, v string")
        stamped = landing.stamp(raw, schema, day)
        landing.load(spark, stamped, place, ["k"], scenario, day, compute_cdc=True, source_schema=schema)

    load([1, 2], "old", "2025-04-08", "historical_run")
    load([1], "new", "2025-04-09", "daily_run")
    last = landing.read_table(spark, place).filter("business_date = date'2025-04-09'").collect()
    assert any(r["__$operation"] == landing.DELETE and r.k == 2 for r in last)
    assert {r.source_schema for r in last} == {"new"}


def test_corrected_rows_belong_to_the_schema_of_their_run(spark, tmp_path):
    place = str(tmp_path / "t")
    raw = spark.createDataFrame([(1, "x"), (2, "x")], "k int, v string")
    landing.append(landing.stamp(raw, "cdc", "2025-04-08"), place)
    fixed = spark.createDataFrame([(1, "y", A)], "k int, v string, business_date date")
    with pytest.raises(ValueError, match="source_schema"):
        landing.correct_rows(spark, place, fixed, ["k"])
    landing.correct_rows(spark, place, fixed, ["k"], "cdc")
    assert {(r.k, r.v, r.source_schema) for r in landing.read_table(spark, place).collect()} == {(1, "y", "cdc"), (2, "x", "cdc")}
