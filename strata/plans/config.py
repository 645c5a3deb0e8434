"""The metadata that drives a run: schemas, look-ups and the flattened views.

Look-ups are DataFrame operations, so they also run over configuration tables that
have grown large; only the final, checked single row comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from strata.functions.text import fill_path, first_non_empty
from strata.operators.ordered import latest_per_key
from strata.operators.quality import Rule
from strata.operators.transform import TransformRule

# fixed values: columns and types of the configuration tables
SOURCE_CONFIG = (
    "dimension_table string, source_system string, source_schema string, source_type string, "
    "sourced_from string, source_details string, derived_input_tables string, "
    "derived_target_tables string, target_table string, scenario string, frequency string, "
    "file_format string, business_date_column_to_load string, test_mode string, is_active string, "
    "deactivation_date timestamp, create_date timestamp, update_date timestamp"
)
CDC_CONFIG = (
    "dimension_table string, target_table string, key_attr string, sequence_col string, "
    "exclude_columns array<string>, compute_cdc string, scd_type string, "
    "create_date timestamp, update_date timestamp"
)
DQ_CONFIG = (
    "dimension_table string, source_system string, target_table string, source_column_name string, "
    "action string, constraint string, is_active string, deactivation_date timestamp, "
    "mocked_ind boolean, create_date timestamp, update_date timestamp"
)
TRANSFORM_CONFIG = (
    "dimension_table string, source_system string, target_table string, source_column_name string, "
    "transform_type string, transform_fn_name string, is_active string, "
    "deactivation_date timestamp, create_date timestamp, update_date timestamp"
)
SOURCE_PARAMS = (
    "map<string, struct<business_date: string, source_system: string, target_table: string, "
    "source_details: string, file_format: string>>"
)
RUNTIME_CONFIG = (
    f"dimension_table string, run_date timestamp, scenario string, source_params {SOURCE_PARAMS}"
)
TEST_SCENARIOS = (
    "dimension_table string, scenario string, scenario_description string, scenario_type string, "
    "refresh_type string, cleanup_table_list array<string>, scenario_input_source_system string, "
    "scenario_input_target_table string, scenario_input_business_date date, "
    "scenario_input_source_details string, scenario_input_format string, created_at timestamp"
)


def same_text(column: str, value: str) -> Column:
    return F.lower(F.col(column)) == value.lower()


def entries(column: Column) -> Column:
    """The trimmed entries of a comma list."""
    return F.transform(F.split(column, ","), lambda entry: F.trim(entry))


def lists(column: str, value: str) -> Column:
    """The comma list in ``column`` has ``value`` as a whole entry."""
    return F.array_contains(entries(F.lower(F.col(column))), value.lower())


def one_row(df: DataFrame, what: str) -> Row:
    found = df.take(2)
    if len(found) != 1:
        raise LookupError(f"{what}: expected one row, found {'none' if not found else 'several'}")
    return found[0]


def source_rows(
    config: DataFrame,
    dimension: str,
    target: str,
    source_system: str,
    scenario: str,
    test_mode: str = "",
) -> DataFrame:
    """Active source rows of one target, source system and scenario."""
    chosen = config.distinct().filter(
        same_text("dimension_table", dimension)
        & same_text("target_table", target)
        & same_text("source_system", source_system)
        & lists("scenario", scenario)
        & (F.col("is_active") == "Y")
    )
    return chosen.filter(same_text("test_mode", test_mode)) if test_mode else chosen


def resolve_source(
    rows: DataFrame,
    business_date: Column,
    incremental: Column,
    override_path: Column,
    override_format: Column,
    date_format: str = "yyyyMMdd",
) -> DataFrame:
    """Path and format to read: the date goes into the template on incremental runs,
    and a path or format given with the run replaces the configured one.

    A source may have its own pattern for the date, in a column ``path_date_format``.
    """
    pattern = F.lit(date_format)
    if "path_date_format" in rows.columns:
        pattern = first_non_empty(F.col("path_date_format"), pattern)
    dated = fill_path(F.col("source_details"), F.call_function("date_format", business_date, pattern))
    path = F.when(incremental, dated).otherwise(F.col("source_details"))
    return rows.withColumns(
        {
            "source_details": first_non_empty(override_path, path),
            "file_format": first_non_empty(override_format, F.col("file_format")),
        }
    )


def latest_run(runtime: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Latest run request per dimension."""
    order = [F.col("run_date").desc(), *[F.col(c).desc() for c in tie]]
    return latest_per_key(runtime, ["dimension_table"], order)


def run_inputs(runtime: DataFrame) -> DataFrame:
    """One row per source of a run request."""
    return runtime.select(
        "dimension_table", "run_date", "scenario", F.explode("source_params").alias("input", "p")
    ).select("dimension_table", "run_date", "scenario", "input", "p.*")


def run_requests(scenarios: DataFrame, run_date: Column) -> DataFrame:
    """Group scenario rows into one run request each: a map of input id to parameters.

    A request lists its sources, so its size is that of the configuration.
    """
    text = {
        "business_date": F.col("scenario_input_business_date").cast("string"),
        "source_system": F.col("scenario_input_source_system"),
        "target_table": F.col("scenario_input_target_table"),
        "source_details": F.col("scenario_input_source_details"),
        "file_format": F.col("scenario_input_format"),
    }
    params = F.struct(*[c.alias(n) for n, c in text.items()])
    # every column of an input takes part, so two dates or two paths of one source differ
    name = F.concat_ws("/", *[F.coalesce(c, F.lit("")) for c in (
        text["source_system"], text["target_table"], text["business_date"], text["source_details"],
        text["file_format"])])
    return scenarios.groupBy("dimension_table", "scenario_type").agg(
        F.map_from_entries(F.sort_array(F.collect_set(F.struct(name, params)))).alias("source_params")
    ).select(
        "dimension_table",
        run_date.alias("run_date"),
        F.col("scenario_type").alias("scenario"),
        "source_params",
    )


def paired_tables(config: DataFrame) -> DataFrame:
    """One row per (input table, target table) pair of the two comma lists."""

    pairs = F.arrays_zip(
        entries(F.col("derived_input_tables")).alias("input_table"),
        entries(F.col("derived_target_tables")).alias("target"),
    )
    exploded = config.withColumn("pair", F.explode(pairs))
    return exploded.select(
        *config.columns,
        F.col("pair.input_table").alias("input_table"),
        F.col("pair.target").alias("derived_target"),
    )


def targets_of_run(
    config: DataFrame, dimension: str, targets: Sequence[str], systems: Sequence[str], scenario: str
) -> DataFrame:
    """Target tables a run writes, each with the sorted set of its source systems."""
    chosen = config.filter(
        same_text("dimension_table", dimension)
        & (F.col("is_active") == "Y")
        & F.lower("target_table").isin([t.lower() for t in targets])
        & F.lower("source_system").isin([s.lower() for s in systems])
        & lists("scenario", scenario)
    )
    return systems_per_target(chosen)


def systems_per_target(config: DataFrame) -> DataFrame:
    exploded = config.select(
        "source_system", F.explode(F.split("derived_target_tables", ",")).alias("target")
    )
    return exploded.groupBy(F.trim("target").alias("target_table")).agg(
        F.sort_array(F.collect_set("source_system")).alias("source_systems")
    )


def cdc_settings(config: DataFrame, target: str) -> Row:
    return one_row(config.filter(same_text("target_table", target)), f"cdc settings of {target}")


def active_rules(config: DataFrame, dimension: str, source_system: str, target: str) -> DataFrame:
    """Active quality or transform rules of one source and target."""
    return config.filter(
        same_text("dimension_table", dimension)
        & same_text("source_system", source_system)
        & same_text("target_table", target)
        & (F.col("is_active") == "Y")
    )


def quality_rules(config: DataFrame, dimension: str, source_system: str, target: str) -> list[Rule]:
    rows = active_rules(config, dimension, source_system, target).select(
        F.upper("action").alias("action"), "constraint", "source_column_name"
    )
    return [Rule(r[0], r[1], r[2]) for r in rows.collect()]


def transform_rules(
    config: DataFrame, dimension: str, source_system: str, target: str
) -> list[TransformRule]:
    """Transforms in the order they apply: by ``rule_order`` if the configuration has that
    column, rules without a number last; equal numbers by column, type and function."""
    number = F.col("rule_order") if "rule_order" in config.columns else F.lit(None).cast("int")
    rows = active_rules(config, dimension, source_system, target).select(
        "source_column_name", "transform_type", "transform_fn_name", number.alias("rule_order")
    ).collect()
    if "rule_order" in config.columns:
        last = max((r[3] for r in rows if r[3] is not None), default=0) + 1
        rows.sort(key=lambda r: (last if r[3] is None else r[3], str(r[0]), str(r[1]), str(r[2])))
    return [TransformRule(r[0], r[1], r[2]) for r in rows]


def flat_sources(
    links: DataFrame, sources: DataFrame, tables: DataFrame, scenarios: DataFrame
) -> DataFrame:
    """Normalised configuration to one row per source, target, scenario and dimension.

    ``links`` holds (source_id, input_table_id, target_table_id, dimension_table_id,
    scenario_id). Links are made distinct before any join, and the dimension is optional.
    Inactive sources are left out.
    """
    used = links.distinct()
    named = tables.select("table_id", "table_name")

    def table(role: str) -> DataFrame:
        return named.toDF(f"{role}_table_id", f"{role}_table")

    joined = (
        used.join(sources.filter("is_active"), "source_id")
        .join(table("input"), "input_table_id")
        .join(table("target"), "target_table_id")
        .join(table("dimension"), "dimension_table_id", "left")
        .join(scenarios, "scenario_id")
    )
    return joined.groupBy(
        "source_name", "source_system", F.col("dimension_table"), "scenario_name", "target_table"
    ).agg(
        F.array_join(F.sort_array(F.collect_set("input_table")), ",").alias("derived_input_tables"),
        F.max(F.when(F.col("test_mode"), "Y").otherwise("N")).alias("test_mode"),
    )


def flat_rules(rules: DataFrame, links: DataFrame, tables: DataFrame) -> DataFrame:
    """Cdc, quality or transform rules with the names of their input and target table."""
    named = tables.select("table_id", "table_name")
    return (
        rules.join(links, "pipeline_config_id")
        .join(named.toDF("input_table_id", "input_table"), "input_table_id")
        .join(named.toDF("target_table_id", "target_table"), "target_table_id")
        .select("input_table", "target_table", *[c for c in rules.columns if c != "pipeline_config_id"])
    )
