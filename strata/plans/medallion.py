"""A whole run: landing load, silver refresh and gold build, driven by configuration."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata.operators.bronze import to_bronze
from strata.operators.mapping import EntityMapping, choose_mapping, map_entity
from strata.operators.scd import present_scd2, scd1, scd2
from strata.operators.transform import apply_transforms
from strata.plans import config as meta
from strata.sources import landing, rebuilt
from strata.sources.contracts import required_columns
from strata.sources.maintained import Maintained, apply_changes, current
from strata.streaming.flows import MAX_FILES, read_batches, read_folder, refine


@dataclass(frozen=True)
class Tables:
    """Folders of one environment. A full refresh of silver takes the next generation
    (:func:`full_refresh`), which starts with empty tables and checkpoints."""

    root: str
    generation: int = 0

    def landing(self, name: str) -> str:
        return f"{self.root}/landing/{name.lower()}"

    def silver(self, kind: str, name: str) -> str:
        return f"{self.root}/silver-{self.generation}/{kind}/{name.lower()}"

    def published(self, name: str) -> str:
        return f"{self.root}/published/{name.lower()}"


def _generations(spark: SparkSession, root: str) -> list[int]:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/silver-*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(f.getPath().getName().removeprefix("silver-")) for f in found or [])


def newest(spark: SparkSession, root: str) -> Tables:
    """The tables of the generation in use."""
    return Tables(root, max(_generations(spark, root), default=0))


def full_refresh(
    spark: SparkSession, root: str, dimension: Dimension, runtime: DataFrame, processing_time: int, test_mode: str = ""
) -> Tables:
    """Load landing anew and start a silver generation of its own from it, in one run.

    The generation before stays readable until the new one is there.
    """
    tables = Tables(root, max(_generations(spark, root), default=-1) + 1)
    load_landing(spark, tables, dimension, runtime, refresh="full_refresh", test_mode=test_mode)
    refresh_silver(spark, tables, dimension, runtime, processing_time, test_mode)
    return tables


@dataclass(frozen=True)
class Dimension:
    """Everything that is specific to one dimension."""

    name: str
    sources: DataFrame
    cdc: DataFrame
    quality: DataFrame
    transforms: DataFrame
    contracts: Mapping[tuple[str, str, str], Sequence[str]]
    mappings: Callable[[], Mapping[tuple[str, str], EntityMapping]]
    snapshot_keys: Mapping[str, Sequence[str]] = field(default_factory=dict)


@dataclass(frozen=True)
class Input:
    """One requested source with its resolved settings."""

    system: str
    schema: str
    path: str
    file_format: str
    business_date: str
    date_column: str | None
    pairs: list[tuple[str, str]]


def requested_inputs(dimension: Dimension, runtime: DataFrame, test_mode: str) -> tuple[str, list[Input]]:
    """Scenario and sources of the latest run request; its size is the configuration's."""
    wanted = meta.run_inputs(
        meta.latest_run(runtime.filter(meta.same_text("dimension_table", dimension.name)))
    ).collect()
    if not wanted:
        raise LookupError(f"no run request for {dimension.name}")
    return wanted[0]["scenario"], [_resolve(dimension, row, test_mode) for row in wanted]


def _resolve(dimension: Dimension, wanted: Row, test_mode: str) -> Input:
    scenario = wanted["scenario"]
    rows = meta.source_rows(
        dimension.sources,
        dimension.name,
        wanted["target_table"],
        wanted["source_system"],
        scenario,
        test_mode,
    )
    resolved = meta.resolve_source(
        rows,
        F.lit(wanted["business_date"]).cast("date"),
        F.lit(scenario != "historical_run"),
        F.lit(wanted["source_details"]),
        F.lit(wanted["file_format"]),
    )
    found = meta.one_row(resolved, f"source of {wanted['target_table']} from {wanted['source_system']}")
    inputs = [t.strip() for t in found["derived_input_tables"].split(",")]
    targets = [t.strip() for t in found["derived_target_tables"].split(",")]
    return Input(
        found["source_system"],
        found["source_schema"],
        found["source_details"],
        found["file_format"],
        wanted["business_date"],
        found["business_date_column_to_load"],
        list(zip(inputs, targets, strict=True)),
    )


def load_landing(
    spark: SparkSession,
    tables: Tables,
    dimension: Dimension,
    runtime: DataFrame,
    refresh: str = "incremental_refresh",
    correction: str | None = None,
    test_mode: str = "",
) -> None:
    """Read every requested source and load it into the landing tables of its inputs.

    A row correction changes landing directly, so there is nothing to read for it.
    """
    if correction == "delta_correction":
        return
    scenario, inputs = requested_inputs(dimension, runtime, test_mode)
    for item in inputs:
        raw = landing.read_files(spark, item.path, item.file_format)
        date_column = item.date_column if item.date_column in raw.columns else None
        sends_operations = landing.OPERATION in raw.columns
        stamped = landing.stamp(raw, item.schema, item.business_date, date_column)
        for table, target in item.pairs:
            settings = meta.cdc_settings(dimension.cdc, target)
            landing.load(
                spark,
                stamped,
                tables.landing(table),
                dimension.snapshot_keys.get(table, ()),
                scenario,
                item.business_date,
                compute_cdc=settings["compute_cdc"] == "Y" and not sends_operations,
                refresh=refresh,
                correction=correction,
                source_schema=item.schema,
                one_date=date_column is None,
            )


def refresh_silver(
    spark: SparkSession,
    tables: Tables,
    dimension: Dimension,
    runtime: DataFrame,
    processing_time: int,
    test_mode: str = "",
    max_files: int = MAX_FILES,
) -> list[str]:
    """Stream what landing has gained through typing, rules, transforms and mapping.

    Each source schema of an input has its own contract, and so its own stream: it takes
    the rows of that schema, remembers its own place, and writes to its own folders, so
    streams of one input never write over each other. Every batch of mapped rows is then
    committed to its target's maintained table, which costs what the batch touches. Returns
    the target tables that were fed.
    """
    _, inputs = requested_inputs(dimension, runtime, test_mode)
    mappings = dimension.mappings()
    fed = []
    for item in inputs:
        for table, target in item.pairs:
            rules = meta.quality_rules(dimension.quality, dimension.name, item.system, target)
            changes = meta.transform_rules(dimension.transforms, dimension.name, item.system, target)
            mapping = choose_mapping(mappings, item.system, target)
            columns = required_columns(dimension.contracts, item.system, item.schema, table)
            place = tables.landing(table)

            def typed(df: DataFrame, columns: Sequence[str] = columns) -> DataFrame:
                return to_bronze(df, columns, processing_time)

            def onward(df: DataFrame, changes=changes, mapping=mapping) -> DataFrame:
                return map_entity(apply_transforms(df, changes), mapping)

            schema = item.schema.replace("/", "")
            kept, exclude = maintained(tables, dimension, target)
            feed = f"{table}-{schema}"

            def upkeep(df: DataFrame, batch: int, kept=kept, exclude=exclude, feed=feed) -> None:
                # as the batch has just been written, its size stands in the files' footers
                apply_changes(kept, df.drop(*exclude), feed, batch, df.count())

            arrived = read_folder(spark, place, landing.read_table(spark, place).schema, max_files)
            refine(
                arrived.filter(F.col("source_schema").eqNullSafe(F.lit(item.schema))),
                tables.silver("checkpoint", f"{table}-{target}-{schema}"),
                typed,
                rules,
                onward,
                f"{tables.silver('mapped', target)}/input={table}/of_schema={schema}",
                f"{tables.silver('audit', 'dq')}/input={table}/of_target={target}/of_schema={schema}",
                (dimension.name, target, table),
                upkeep,
            )
            fed.append(target)
    return list(dict.fromkeys(fed))


def maintained(tables: Tables, dimension: Dimension, target: str) -> tuple[Maintained, list[str]]:
    """The table of a target that runs keep up to date, and the columns it leaves out."""
    settings = meta.cdc_settings(dimension.cdc, target)
    keys = [k.strip() for k in settings["key_attr"].split(",")]
    exclude = settings["exclude_columns"] or []
    history = settings["scd_type"] == "2"
    return Maintained(tables.silver("state", target), keys, settings["sequence_col"], history=history), exclude


def entity(spark: SparkSession, tables: Tables, dimension: Dimension, target: str) -> DataFrame:
    """The presented type 1 or type 2 table of one target, all sources together.

    It is read as the runs have left it; :func:`derived_entity` gives the same rows from all
    mapped batches.
    """
    kept, _ = maintained(tables, dimension, target)
    rows = current(spark, kept)
    return present_scd2(rows) if kept.history else rows


def derived_entity(spark: SparkSession, tables: Tables, dimension: Dimension, target: str) -> DataFrame:
    """The table of one target, derived anew from everything that was ever mapped to it."""
    kept, exclude = maintained(tables, dimension, target)
    changes = read_batches(spark, tables.silver("mapped", target)).drop("input", "of_schema", *exclude)
    if kept.history:
        return present_scd2(scd2(changes, kept.keys, kept.sequence))
    return scd1(changes, kept.keys, kept.sequence)


def gold_table(tables: Tables, name: str, keys: Sequence[str]) -> rebuilt.Rebuilt:
    """A gold table that runs keep up to date; each silver generation has its own."""
    return rebuilt.Rebuilt(tables.silver("gold", name), keys)


def refresh_gold(
    spark: SparkSession,
    tables: Tables,
    dimension: Dimension,
    gold: rebuilt.Rebuilt,
    targets: Sequence[str],
    build: Callable[..., DataFrame],
    whole: bool = False,
) -> rebuilt.State:
    """Build gold anew for the keys that silver commits have touched since the last refresh.

    ``build`` takes the presented ``targets`` in order. Its rows of a key must follow from
    the key's own rows, and the key must be part of every target's key.
    """
    kept = {target: maintained(tables, dimension, target)[0] for target in targets}

    def made(*rows: DataFrame) -> DataFrame:
        return build(*(present_scd2(r) if k.history else r for r, k in zip(rows, kept.values(), strict=True)))

    return rebuilt.refresh(spark, gold, kept, made, whole)


def audit(spark: SparkSession, tables: Tables) -> DataFrame:
    return read_batches(spark, tables.silver("audit", "dq")).drop("input", "of_target", "of_schema")


def publish(tables: Tables, name: str, df: DataFrame, run: int) -> None:
    """Write a recomputed table as its own run; readers see a run once it is complete.

    A run that is repeated after a failure overwrites its own folder only.
    """
    df.write.mode("overwrite").parquet(f"{tables.published(name)}/run={run}")


def complete_runs(spark: SparkSession, tables: Tables, name: str) -> list[int]:
    """Numbers of the runs whose files are all there, as the commit mark says."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{tables.published(name)}/run=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(f.getPath().getParent().getName().removeprefix("run=")) for f in found or [])


def published(spark: SparkSession, tables: Tables, name: str, run: int | None = None) -> DataFrame:
    """A complete run of a published table, without a number the latest; half-written
    runs are never read."""
    runs = complete_runs(spark, tables, name)
    if not runs or run is not None and run not in runs:
        raise LookupError(f"{name}: run {'any' if run is None else run} is not published")
    return spark.read.parquet(f"{tables.published(name)}/run={runs[-1] if run is None else run}")
