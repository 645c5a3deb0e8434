"""The five run scenarios in sequence: history, second source, dated runs, corrections."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import QualityFailure
from strata.plans import config as meta
from strata.plans import group_dimension as dim
from strata.plans.medallion import (
    Dimension,
    Tables,
    audit,
    derived_entity,
    entity,
    full_refresh,
    gold_table,
    load_landing,
    maintained,
    newest,
    publish,
    published,
    refresh_gold,
    refresh_silver,
)
from strata.sources import landing, rebuilt
from strata.sources.maintained import commits, read_commit

GROUPS, COUNTED, SECOND = 1000, 500, 500
APRIL_8, APRIL_22 = "2025-04-08", "2025-04-22"


def group_feed(spark, first, last, name, operation="5", day="2020-01-01"):
    """Rows of the combined entity and history delivery of the first system."""
    number = F.col("id")
    made = {
        "GRGR_CK": number.cast("int"),
        "GRGR_ID": F.when(number % 10 == 3, "XXXXX").otherwise(F.concat(F.lit(" G"), number.cast("string"))),
        "GRGR_NAME": F.concat(F.lit(name), number.cast("string"), F.lit(" ")),
        "GRGR_MCTR_TYPE": F.when(number % 10 == 7, "UNK").otherwise("LG"),
        "GRGR_CTRY_CD": F.lit("US"),
        "GRGR_RENEW_MMDD": F.lit(101).cast("smallint"),
        "GRGR_ERIS_MMDD": F.lit(701).cast("smallint"),
    }
    stamps = {"GRGR_ORIG_EFF_DT", "GRGR_CONV_DT", "GRGR_TERM_DT", "GRGR_RNST_DT"}
    for column in dict.fromkeys([*dim.A_GROUP_COLUMNS, *dim.A_HISTORY_COLUMNS]):
        if column not in made:
            made[column] = F.lit("2001-01-01 00:00:00").cast("timestamp") if column in stamps else F.lit("s")
    return spark.range(first, last).select(
        *[c.alias(n) for n, c in made.items()],
        F.lit(202504081230).alias("loadtimestamp"),
        F.lit(f"{day} 00:00:00").cast("timestamp").alias("transaction_dtm"),
        F.lit(operation).alias("__$operation"),
    )


def count_feed(spark, first, last, employees):
    return spark.range(first, last).select(
        F.col("id").cast("int").alias("GRGR_CK"),
        F.lit("MLRR ").alias("GRGC_MCTR_CTYP"),
        F.lit("2021-01-01 00:00:00").cast("timestamp").alias("GRGC_EFF_DT"),
        F.lit("2023-01-01 00:00:00").cast("timestamp").alias("GRGC_TERM_DT"),
        F.when(F.col("id") % 5 == 0, 0).otherwise(employees).alias("GRGC_COUNT"),
        F.lit(202504081230).alias("loadtimestamp"),
    )


def second_feed(spark, count):
    names = [n for n in dict.fromkeys([*dim.B_GROUP_COLUMNS, *dim.B_HISTORY_COLUMNS])]
    made = {
        "Group ID": F.concat(F.lit("B"), F.col("id").cast("string")),
        "Group Original Effective Date": F.lit(" 20200101 "),
        "Group Termination Date": F.when(F.col("id") % 2 == 0, "20781231").otherwise("20250630"),
        "Group Address Line 2": F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise("Suite"),
    }
    return spark.range(count).select(
        *[made.get(n, F.lit("t")).alias(n) for n in names],
        F.lit(202504081230).alias("loadtimestamp"),
        F.when(F.col("id") == 1, "D").otherwise("I").alias("Operation Code"),
    )


class World:
    def __init__(self, spark, root):
        self.spark, self.raw = spark, f"{root}/raw"
        self.tables = Tables(f"{root}/tables")
        self.dimension = Dimension(
            dim.DIMENSION,
            dim.source_config(spark, self.raw),
            dim.cdc_config(spark),
            dim.dq_config(spark),
            dim.transform_config(spark),
            dim.CONTRACTS,
            dim.mappings,
            dim.SNAPSHOT_KEYS,
        )
        self.clock = 0

    def request(self, scenario, *inputs):
        rows = [
            ("D_GROUP", "1", "", scenario, "", [], system, target, date.fromisoformat(day), path, "", None)
            for system, target, day, path in inputs
        ]
        scenarios = self.spark.createDataFrame(rows, meta.TEST_SCENARIOS)
        return meta.run_requests(scenarios, F.lit(datetime(2025, 5, 1)))

    def run(self, scenario, *inputs, test_mode="Y", **load):
        self.clock += 1
        runtime = self.request(scenario, *inputs)
        load_landing(self.spark, self.tables, self.dimension, runtime, test_mode=test_mode, **load)
        refresh_silver(self.spark, self.tables, self.dimension, runtime, self.clock, test_mode)

    def entity(self, name):
        return entity(self.spark, self.tables, self.dimension, name)

    def assert_kept(self):
        """Maintained tables hold what all mapped batches together give."""
        for name in ("DF_Group", "DF_Group_History", "DF_Group_Count"):
            kept = self.entity(name)
            derived = derived_entity(self.spark, self.tables, self.dimension, name).select(*kept.columns)
            assert kept.exceptAll(derived).isEmpty() and derived.exceptAll(kept).isEmpty()

    def refresh_gold(self, build=dim.gold):
        """The gold table after a refresh, which must equal one built from everything."""
        names = ("DF_Group", "DF_Group_History", "DF_Group_Count")
        gold = gold_table(self.tables, "d_group", ["Group_Source_Key", "Source_System_Code"])
        state = refresh_gold(self.spark, self.tables, self.dimension, gold, names, build)
        kept, whole = rebuilt.shown(self.spark, gold), build(*map(self.entity, names))
        assert kept.exceptAll(whole).isEmpty() and whole.exceptAll(kept).isEmpty()
        return gold, state

    def landed(self, name):
        return landing.read_table(self.spark, self.tables.landing(name))


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    return World(spark, str(tmp_path_factory.mktemp("world")))


def test_1_history_of_the_first_source(world):
    spark = world.spark
    group_feed(spark, 0, GROUPS, "acme ").write.parquet(f"{world.raw}/A/Test/History/{dim.A_GROUP}")
    count_feed(spark, 0, COUNTED, 10).write.parquet(f"{world.raw}/A/Test/History/{dim.A_COUNT}")
    world.run(
        "historical_run",
        ("Facets", "DF_GROUP", "1900-01-01", ""),
        ("Facets", "DF_GROUP_COUNT", "1900-01-01", ""),
        refresh="full_refresh",
    )
    assert world.landed(dim.A_GROUP).count() == world.landed(dim.A_HISTORY).count() == GROUPS
    group = world.entity("DF_Group")
    assert group.count() == GROUPS * 9 // 10  # one in ten is quarantined
    row = group.filter("Group_Source_Key = '1'").first()
    assert (row.Group_Id, row.Group_Name, row.business_date) == ("G1", "Acme 1", date(2020, 1, 1))
    assert world.entity("DF_Group_Count").count() == COUNTED * 4 // 5
    kinds = {
        (r.target_table, r.dq_type): r["count"]
        for r in audit(spark, world.tables).groupBy("target_table", "dq_type").count().collect()
    }
    assert kinds == {
        ("DF_Group", "QUARANTINE"): GROUPS // 10,
        ("DF_Group", "WARN"): GROUPS // 10,
        ("DF_Group_History", "QUARANTINE"): GROUPS // 10,
        ("DF_Group_Count", "QUARANTINE"): COUNTED // 5,
    }


def test_2_second_source_joins(world):
    second_feed(world.spark, SECOND).write.option("header", "true").csv(f"{world.raw}/B/History/Group")
    world.run("historical_run", ("VHP", "DF_GROUP", "1900-01-01", ""))
    group = world.entity("DF_Group")
    by_system = {r.Source_System_Code: r["count"] for r in group.groupBy("Source_System_Code").count().collect()}
    assert by_system == {"Facets": 900, "VHP": SECOND}
    row = group.filter("Group_Source_Key = 'B2'").first()
    assert (row.Original_Effective_Date, row.ITS_Code) == (date(2020, 1, 1), "")
    history = world.entity("DF_Group_History").filter("Source_System_Code = 'VHP'")
    terms = {r.Termination_Date for r in history.collect()}
    assert terms == {date(9999, 12, 31), date(2025, 6, 30)}
    warned = audit(world.spark, world.tables).filter("validated_table = 'ma_group_history'")
    assert warned.count() == SECOND // 4
    assert history.filter("Row_Is_Deleted_Ind = 'Y'").count() == 1


def test_3_dated_runs_add_versions_and_deletes(world):
    spark = world.spark
    changed = group_feed(spark, 0, 110, "renamed ", day="2025-04-08").drop("transaction_dtm")
    changed.write.parquet(f"{world.raw}/A/Test/BusinessStartDate=20250408/{dim.A_GROUP}")
    count_feed(spark, 100, COUNTED + 50, 20).write.parquet(
        f"{world.raw}/A/Test/BusinessStartDate=20250422/{dim.A_COUNT}"
    )
    before = world.entity("DF_Group_History").count()
    world.run(
        "incremental_run",
        ("Facets", "DF_GROUP", APRIL_8, ""),
        ("Facets", "DF_GROUP_COUNT", APRIL_22, ""),
    )
    good = 110 * 9 // 10
    history = world.entity("DF_Group_History")
    assert history.count() == before + good
    assert history.filter("Row_Term_Date = date'2025-04-08'").count() == good
    assert world.entity("DF_Group").filter("Group_Name like 'Renamed%'").count() == good
    counts = world.entity("DF_Group_Count")
    # 100 groups left the snapshot; those with no employees were never taken in
    gone = counts.filter("Row_Is_Deleted_Ind = 'Y'")
    assert gone.count() == 80 and {r.business_date for r in gone.collect()} == {date(2025, 4, 22)}
    assert counts.filter("Employee_Count = 20").count() == 450 * 4 // 5


def test_4_corrected_file_replaces_its_date(world):
    spark = world.spark
    place = f"{world.raw}/corrected/20250408"
    group_feed(spark, 0, 60, "corrected ", day="2025-04-08").drop("transaction_dtm").write.parquet(place)
    others = world.landed(dim.A_GROUP).filter("business_date <> date'2025-04-08'").count()
    world.run(
        "apply_correction", ("Facets", "DF_GROUP", APRIL_8, place), correction="file_correction"
    )
    landed = world.landed(dim.A_GROUP)
    assert landed.filter("business_date = date'2025-04-08'").count() == 60
    assert landed.filter("business_date <> date'2025-04-08'").count() == others
    group = world.entity("DF_Group")
    assert group.filter("Group_Name like 'Corrected%'").count() == 54
    active = world.entity("DF_Group_History").filter(
        "business_date = date'2025-04-08' and Row_Is_Active_Ind = 'Y' and processing_time = 4"
    )
    assert active.count() == 54


def test_5_single_rows_are_corrected(world):
    table = world.tables.landing(dim.A_GROUP)
    wrong = world.landed(dim.A_GROUP).filter("business_date = date'2025-04-08' and GRGR_CK = 5")
    fixed = wrong.withColumn("GRGR_NAME", F.lit("north ridge, l.l.c"))
    landing.correct_rows(world.spark, table, fixed, ["GRGR_ID", "GRGR_CK"])
    assert world.landed(dim.A_GROUP).filter("business_date = date'2025-04-08'").count() == 60
    world.run(
        "apply_correction", ("Facets", "DF_GROUP", APRIL_8, ""), correction="delta_correction"
    )
    row = world.entity("DF_Group").filter("Group_Source_Key = '5'").first()
    assert (row.Group_Name, row.processing_time) == ("North Ridge, L.l.c", 5)


def test_5b_kept_tables_equal_derived_ones(world):
    world.assert_kept()


def test_5c_a_small_run_touches_little(world):
    spark = world.spark
    _, gold = world.refresh_gold()
    place = f"{world.raw}/small/20250501"
    group_feed(spark, 200, 203, "small ", day="2025-05-01").drop("transaction_dtm").write.parquet(place)
    kept, _ = maintained(world.tables, world.dimension, "DF_Group_History")
    before = read_commit(spark, kept)
    world.run("incremental_run", ("Facets", "DF_GROUP", "2025-05-01", place))
    after = read_commit(spark, kept)
    # two of three rows are good, 203 ends in 3; each gives a version and ends the open one
    good = [n for n in range(200, 203) if n % 10 != 3]
    assert after.base == before.base and after.delta_rows - before.delta_rows == 2 * len(good)
    assert len(commits(spark, kept)) == after.number
    world.assert_kept()
    place, later = world.refresh_gold()
    assert later.base == gold.base and gold.deltas == []
    rebuilt_keys = spark.read.parquet(f"{place.root}/keys-{later.number}")
    assert {r.Group_Source_Key for r in rebuilt_keys.collect()} == {str(n) for n in good}


def test_6_gold_over_all_sources(world):
    names = ("DF_Group", "DF_Group_History", "DF_Group_Count")
    for name in names:
        publish(world.tables, name, world.entity(name), 5)
    silver = [published(world.spark, world.tables, name, 5) for name in names]
    publish(world.tables, "d_group", dim.gold(*silver), 5)
    found = published(world.spark, world.tables, "d_group", 5).collect()
    # counts run 2021 to 2023 inside the first version of each group's history
    assert {(r.Row_Effective_Date, r.Row_Term_Date) for r in found} == {(date(2021, 1, 1), date(2023, 1, 1))}
    assert {r.Count_Type for r in found} == {"Group Response"}
    assert len({r.Group_Source_Key for r in found}) == len(found)
    # the second source sends no counts and only shows where none are required
    wide = dim.gold(*silver, require_counts=False)
    assert wide.filter("Group_Source_Key like 'B%'").count() == SECOND - 1
    assert not any(r.Group_Source_Key.startswith("B") for r in found)


def test_7_bad_keys_stop_the_run(world):
    spark = world.spark
    place = f"{world.raw}/broken"
    group_feed(spark, 0, 5, "x").withColumn("GRGR_CK", F.lit(None).cast("int")).drop("transaction_dtm").write.parquet(place)
    before = world.entity("DF_Group").count()
    with pytest.raises(Exception, match=f"{QualityFailure.__name__}|GRGR_CK is null: 5 rows"):
        world.run("incremental_run", ("Facets", "DF_GROUP", "2025-05-01", place))
    assert world.entity("DF_Group").count() == before


def test_full_refresh_starts_from_landing_again(world, spark):
    fresh = Tables(world.tables.root, generation=1)
    runtime = world.request("historical_run", ("Facets", "DF_GROUP_COUNT", "1900-01-01", ""))
    refresh_silver(spark, fresh, world.dimension, runtime, 99, "Y")
    again = entity(spark, fresh, world.dimension, "DF_Group_Count")
    assert again.count() == world.entity("DF_Group_Count").count()
    assert {r.processing_time for r in again.collect()} == {99}


def test_published_runs_are_complete(world, spark):
    import os

    publish(world.tables, "half", spark.range(3), 1)
    publish(world.tables, "half", spark.range(4), 2)
    assert published(spark, world.tables, "half").count() == 4
    os.remove(f"{world.tables.published('half')}/run=2/_SUCCESS")
    assert published(spark, world.tables, "half").count() == 3
    with pytest.raises(LookupError):
        published(spark, world.tables, "half", 2)
    with pytest.raises(LookupError):
        published(spark, world.tables, "never")


def test_schemas_of_one_input_do_not_write_over_each_other(spark, tmp_path_factory):
    other = World(spark, str(tmp_path_factory.mktemp("schemas")))
    place = f"{other.tables.root}/more"
    table = dim.A_COUNT
    for number, schema in enumerate(("dbo", "test", "dbo", "test", "dbo")):
        rows = count_feed(spark, 10 * number, 10 * number + 10, 10)
        landing.append(landing.stamp(rows, schema, f"2025-04-0{number + 1}"), other.tables.landing(table))
        if number == 0:
            continue
        for mode in ("N", "Y"):  # the sources of schema dbo and test
            runtime = other.request("historical_run", ("Facets", "DF_GROUP_COUNT", "1900-01-01", place))
            refresh_silver(spark, other.tables, other.dimension, runtime, number, mode, max_files=1)
    mapped = other.entity("DF_Group_Count")
    # counts of nothing are quarantined
    landed = landing.read_table(spark, other.tables.landing(table)).filter("GRGC_COUNT <> 0")
    assert mapped.count() == landed.count() == 40


def test_full_refresh_is_one_run(spark, tmp_path_factory):
    other = World(spark, str(tmp_path_factory.mktemp("refresh")))
    place = f"{other.tables.root}/counts"
    request = other.request("historical_run", ("Facets", "DF_GROUP_COUNT", "1900-01-01", place))
    for number, last in enumerate((30, 12)):
        count_feed(spark, 0, last, 10).write.mode("overwrite").parquet(place)
        tables = full_refresh(spark, other.tables.root, other.dimension, request, 7, "Y")
        assert tables.generation == number and newest(spark, other.tables.root) == tables
        assert entity(spark, tables, other.dimension, "DF_Group_Count").count() > 0
    rows = landing.read_table(spark, tables.landing(dim.A_COUNT)).filter("GRGC_COUNT <> 0").count()
    assert entity(spark, tables, other.dimension, "DF_Group_Count").count() == rows
