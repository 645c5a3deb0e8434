from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strata.plans import config as meta
from strata.plans import group_dimension as dim


def test_seed_rows(spark):
    assert dim.source_config(spark, "/raw").count() == 11
    assert dim.cdc_config(spark).count() == 3
    assert dim.dq_config(spark).count() == 17


def test_source_lookup_is_exact(spark):
    config = dim.source_config(spark, "/raw")
    row = meta.one_row(
        meta.source_rows(config, "d_group", "df_group", "facets", "incremental_run", "n"), "source"
    )
    assert row.source_schema == "cdc"
    with pytest.raises(LookupError, match="several"):
        meta.one_row(meta.source_rows(config, "D_Group", "DF_Group", "Facets", "incremental_run"), "source")
    with pytest.raises(LookupError, match="none"):
        meta.one_row(meta.source_rows(config, "D_Group", "DF_Group", "Facets", "incremental"), "source")


def test_path_and_format(spark):
    config = dim.source_config(spark, "/raw")
    rows = meta.source_rows(config, "D_Group", "DF_Group", "Facets", "incremental_run", "N")

    def resolve(path, kind, incremental=True):
        found = meta.resolve_source(
            rows, F.lit("2025-04-08").cast("date"), F.lit(incremental), F.lit(path), F.lit(kind)
        ).first()
        return found.source_details, found.file_format

    assert resolve("", "") == ("/raw/A/BusinessStartDate=20250408/cmc_grgr_group", "parquet")
    assert resolve(None, None, False) == ("/raw/A/BusinessStartDate={}/cmc_grgr_group", "parquet")
    assert resolve("/fixed", "csv") == ("/fixed", "csv")


def test_rules_per_source_and_target(spark):
    rules = meta.quality_rules(dim.dq_config(spark), "D_GROUP", "facets", "df_group")
    assert sorted(r.action for r in rules) == ["FAIL", "FAIL", "QUARANTINE", "QUARANTINE", "WARN", "WARN"]
    changes = meta.transform_rules(dim.transform_config(spark), "D_Group", "Facets", "DF_Group")
    assert [(c.column, c.function) for c in changes if c.column == "GRGR_NAME"] == [
        ("GRGR_NAME", "trim"), ("GRGR_NAME", "initcap"),
    ]


def test_run_request_round_trip(spark):
    rows = [
        ("D_GROUP", "3", "", "incremental_run", "incremental_refresh", [], "Facets", "DF_GROUP", date(2025, 4, 8), "", "", None),
        ("D_GROUP", "3", "", "incremental_run", "incremental_refresh", [], "Facets", "DF_GROUP_COUNT", date(2025, 4, 22), "", "", None),
        ("D_GROUP", "3", "", "incremental_run", "incremental_refresh", [], "Facets", "DF_GROUP_COUNT", date(2025, 4, 23), "", "", None),
    ]
    scenarios = spark.createDataFrame(rows, meta.TEST_SCENARIOS)
    request = meta.run_requests(scenarios, F.lit(datetime(2025, 5, 1)))
    old = request.withColumn("run_date", F.lit(datetime(2025, 4, 1))).withColumn("scenario", F.lit("old"))
    inputs = meta.run_inputs(meta.latest_run(request.unionByName(old)))
    assert sorted((r.scenario, r.target_table, r.business_date) for r in inputs.collect()) == [
        ("incremental_run", "DF_GROUP", "2025-04-08"),
        ("incremental_run", "DF_GROUP_COUNT", "2025-04-22"),
        ("incremental_run", "DF_GROUP_COUNT", "2025-04-23"),
    ]


def test_targets_and_pairs(spark):
    config = dim.source_config(spark, "/raw")
    found = meta.targets_of_run(
        config, "d_group", ["DF_GROUP", "df_group_count"], ["Facets", "vhp"], "incremental_run"
    )
    assert {r.target_table: r.source_systems for r in found.collect()} == {
        "DF_Group": ["Facets", "VHP"],
        "DF_Group_History": ["Facets", "VHP"],
        "DF_Group_Count": ["Facets"],
    }
    pairs = meta.paired_tables(config.filter("source_system = 'VHP'")).collect()
    assert {(r.input_table, r.derived_target) for r in pairs} == {
        ("ma_group", "DF_Group"), ("ma_group_history", "DF_Group_History"),
    }


def test_flat_rules(spark):
    rules = spark.createDataFrame([(1, "x is null")], "pipeline_config_id int, dq_constraint string")
    links = spark.createDataFrame([(1, 10, 20)], "pipeline_config_id int, input_table_id int, target_table_id int")
    tables = spark.createDataFrame([(10, "in"), (20, "out")], "table_id int, table_name string")
    assert tuple(meta.flat_rules(rules, links, tables).first()) == ("in", "out", "x is null")


def test_transforms_apply_in_the_configured_order(spark):
    config = spark.createDataFrame(
        [("D", "S", "T", c, kind, fn, "Y", None, None, None, n) for c, kind, fn, n in (
            ("a", "t", "third", None), ("b", "t", "first", 1), ("a", "t", "second", 20), ("a", "t", "middle", 7))],
        meta.TRANSFORM_CONFIG + ", rule_order int",
    )
    found = meta.transform_rules(config.repartition(3), "d", "s", "t")
    assert [r.function for r in found] == ["first", "middle", "second", "third"]


def test_a_source_may_have_its_own_path_date(spark):
    rows = spark.createDataFrame(
        [("/in/{}", "csv", "yyyy-MM-dd"), ("/in/{}", "csv", None), ("/in/{}", "csv", "")],
        "source_details string, file_format string, path_date_format string",
    )
    none = F.lit(None).cast("string")
    found = meta.resolve_source(rows, F.lit("2025-04-08").cast("date"), F.lit(True), none, none)
    assert sorted(r.source_details for r in found.collect()) == ["/in/2025-04-08", "/in/20250408", "/in/20250408"]
