"""The landing zone: dated files in, one append-only table per input out.

A landing table is a folder of parquet files partitioned by ``business_date``. Files
are only ever added or, for a whole business date, replaced; both are committed by
Spark's file commit, so a lost executor leaves no partial date behind.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.cdc import DELETE, OPERATION, SNAPSHOT_ROW, snapshot_deletes
from strata.sources.reloads import keep_record, recorded

BUSINESS_DATE = "business_date"
#: number of the load that brought a row; later loads have larger ones
LOAD = "load_sequence"
NO_SOURCE = "Not Used"


def read_files(
    spark: SparkSession,
    path: str,
    file_format: str,
    schema: StructType | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Read a source folder; only csv files carry a header line.

    With a schema, ``malformed`` names the column that keeps the text of csv or json
    lines that do not fit it, instead of losing them.
    """
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", "true")
    if schema is not None and malformed:
        schema = StructType([*schema.fields, StructField(malformed, StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", malformed)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def open_named(spark: SparkSession, name: str, stream: bool = False) -> DataFrame:
    """A catalog table by name, as it is now or as a stream of what is added."""
    return spark.readStream.table(name) if stream else spark.table(name)


def operations_as_text(df: DataFrame) -> DataFrame:
    """Cast every capture column (``__$...``) to string."""
    names = [c for c in df.columns if c.startswith("__$")]
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in names}) if names else df


def stamp(
    df: DataFrame,
    source_schema: str,
    business_date: date | str | None = None,
    date_column: str | None = None,
) -> DataFrame:
    """Provenance, default operation code and business date of raw rows.

    The date comes from ``date_column`` when one is configured, else it is the run's.
    """
    rows = operations_as_text(df)
    if OPERATION not in rows.columns:
        rows = rows.withColumn(OPERATION, F.lit(SNAPSHOT_ROW))
    if date_column and date_column.strip():
        when: Column = F.col(f"`{date_column.strip()}`").cast("date")
    else:
        when = F.lit(business_date).cast("date")
    return rows.withColumns(
        {
            "source": F.lit(NO_SOURCE),
            "source_schema": F.lit(source_schema),
            BUSINESS_DATE: when,
        }
    )


def spread_by_date(df: DataFrame, one_date: bool = False) -> DataFrame:
    """Bring rows of a date together for writing, without one task per date.

    ``rebalance`` lets the adaptive planner split a large date over several tasks and
    join small ones, so files get a useful size and a hot date does not serialise.
    Rows of ``one_date`` stay where they are: any task's rows fill one file, and brought
    together they would all meet in one partition.
    """
    return df if one_date else df.hint("rebalance", F.col(BUSINESS_DATE))


def append(df: DataFrame, table: str, one_date: bool = False) -> None:
    keep_record(df.sparkSession, table)
    spread_by_date(df, one_date).write.mode("append").partitionBy(BUSINESS_DATE).parquet(table)


def overwrite(df: DataFrame, table: str, one_date: bool = False) -> None:
    """Full refresh: the table holds these rows only."""
    with recorded(df.sparkSession, table, [""]):
        (
            spread_by_date(df, one_date)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(BUSINESS_DATE)
            .parquet(table)
        )


def replace_dates(df: DataFrame, table: str) -> None:
    """Reload the business dates present in ``df``; every other date stays as it is."""
    with recorded(df.sparkSession, table):
        (
            spread_by_date(df)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUSINESS_DATE)
            .parquet(table)
        )


def delete_date(spark: SparkSession, table: str, day: date | str) -> None:
    """Remove a business date from a landing table; nothing happens if it is not there."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{table}/{BUSINESS_DATE}={day}")
    with recorded(spark, table, [f"{BUSINESS_DATE}={day}"]):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def correct_file(df: DataFrame, table: str, run_date: date | str) -> None:
    """The corrected file of a run: its dates are replaced, and the run's own date holds
    what the file has for it, also nothing at all."""
    spark = df.sparkSession
    replace_dates(df, table)
    # what the corrected file has for the run's date has replaced the old rows just now
    if df.filter(F.col(BUSINESS_DATE) == F.lit(run_date).cast("date")).isEmpty():
        delete_date(spark, table, run_date)


def correct_rows(
    spark: SparkSession,
    table: str,
    corrected: DataFrame,
    keys: Sequence[str],
    source_schema: str | None = None,
) -> None:
    """Replace single rows: the old rows of the corrected keys go, the new ones come.

    Only the dates the corrected rows belong to are read and written again. Rows without a
    source schema get the run's; without any no stream would take them.
    """
    current = read_table(spark, table)
    if source_schema is not None:
        given = F.col("source_schema") if "source_schema" in corrected.columns else F.lit(None)
        corrected = corrected.withColumn("source_schema", F.coalesce(given, F.lit(source_schema)))
    elif "source_schema" in current.columns and "source_schema" not in corrected.columns:
        raise ValueError(f"corrected rows of {table} need a source_schema")
    renamed = [F.col(f"`{k}`").alias(f"c_{k}") for k in keys]
    fixed = corrected.select(*renamed, F.col(BUSINESS_DATE).alias("c_date")).distinct()
    touched = fixed.select("c_date").distinct()
    affected = current.join(touched, F.col(BUSINESS_DATE) == F.col("c_date"), "left_semi")
    same = F.col(BUSINESS_DATE) == F.col("c_date")
    for key in keys:
        same = same & F.col(f"`{key}`").eqNullSafe(F.col(f"`c_{key}`"))
    kept = affected.join(fixed, same, "left_anti")
    replace_dates(kept.unionByName(corrected, allowMissingColumns=True), table)


def read_table(spark: SparkSession, table: str, schema: StructType | None = None) -> DataFrame:
    """A landing table whose files may have gained columns over time."""
    reader = spark.read.option("mergeSchema", "true")
    if schema is not None:
        reader = spark.read.schema(schema)
    return reader.parquet(table)


def read_table_if_any(spark: SparkSession, table: str) -> DataFrame | None:
    """The table, or ``None`` before the first load."""
    try:
        found = read_table(spark, table)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return None if found.isEmpty() else found


def read_dates(spark: SparkSession, folder: str, first: str, last: str, table: str = "") -> DataFrame:
    """Rows of ``folder/BusinessStartDate=YYYYMMDD/<table>/`` within a range of dates.

    Only the folders in the range are listed and read.
    """
    days = spark.read.option("basePath", folder).parquet(f"{folder}/BusinessStartDate=*/{table}")
    return days.filter(F.col("BusinessStartDate").cast("string").between(first, last))


def load(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    keys: Sequence[str],
    scenario: str,
    run_date: date | str,
    compute_cdc: bool = False,
    refresh: str = "incremental_refresh",
    correction: str | None = None,
    source_schema: str | None = None,
    one_date: bool = False,
) -> None:
    """Load stamped rows of one input into its landing table.

    Deletes are computed from the previous state unless the run loads history or the
    source sends its own operation codes. Delete rows carry the run's date and, if it is
    given, its source schema, whatever schema their key came under. Every row
    carries the number of its load, which settles what is the last word on a key that
    came and went within one date. ``one_date`` says that all rows carry the run's date.
    """
    before = read_table_if_any(spark, table)
    known = before is not None and LOAD in before.columns
    number = ((before.agg(F.max(LOAD)).first()[0] if known else None) or 0) + 1
    if compute_cdc and scenario != "historical_run":
        if not keys:
            raise ValueError(f"deletes of {table} need the key columns of its snapshots")
        order = [BUSINESS_DATE, LOAD] if known else [BUSINESS_DATE]
        rows = snapshot_deletes(rows, before, keys, order)
        deleted = F.col(f"`{OPERATION}`") == DELETE
        stamped = F.when(deleted, F.lit(run_date).cast("date")).otherwise(F.col(BUSINESS_DATE))
        rows = rows.withColumn(BUSINESS_DATE, stamped)
        if source_schema is not None:
            schema = F.when(deleted, F.lit(source_schema)).otherwise(F.col("source_schema"))
            rows = rows.withColumn("source_schema", schema)
    rows = rows.withColumn(LOAD, F.lit(number).cast("long"))
    if refresh == "full_refresh":
        overwrite(rows, table, one_date)
    elif correction == "file_correction":
        correct_file(rows, table, run_date)
    else:
        append(rows, table, one_date)
