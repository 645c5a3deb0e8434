"""Triggered streams over landing folders.

Each run takes what is new and stops. Every output of a micro-batch goes to a folder
named after the batch and overwrites it, so a batch that is run again after a failure
leaves the same files once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.ordered import row_hash
from strata.operators.quality import Rule, assess, audit_records, check_fail_rules, clean_rows
from strata.operators.scd import scd1, scd2
from strata.sources.maintained import Maintained, apply_changes
from strata.sources.reloads import lost

BATCH, BUCKET = "batch_id", "bucket"
#: files of one micro-batch, unless a caller says otherwise
MAX_FILES = 1000
Step = Callable[[DataFrame], DataFrame]


def read_folder(
    spark: SparkSession, folder: str, schema: StructType, max_files: int = MAX_FILES
) -> DataFrame:
    """New files of a folder, each seen once, at most ``max_files`` in a batch.

    A reloaded date arrives as new files, so files of a batch that failed before may have
    gone; :func:`check_files` tells them from files that are lost.
    """
    reader = spark.readStream.schema(schema).option("ignoreMissingFiles", "false")
    return reader.option("maxFilesPerTrigger", max_files).parquet(folder)


def batch_files(spark: SparkSession, checkpoint: str, batch: int) -> list[tuple[str, int]]:
    """Names and times of a batch's files as the checkpoint has them.

    Files that had gone when the batch was opened are not in its plan any more. There are
    at most as many as a batch takes.
    """

    def offset(number: int) -> int:
        lines = [r.value for r in spark.read.text(f"{checkpoint}/offsets/{number}").collect()]
        return next(x["logOffset"] for x in map(json.loads, lines[1:]) if "logOffset" in x)

    first, last = offset(batch - 1) + 1 if batch else 0, offset(batch)
    # every tenth page repeats all earlier ones
    pages = [f"{checkpoint}/sources/0/{n}{{,.compact}}" for n in range(first, last + 1)]
    if not pages:
        return []
    entry = F.from_json("value", "path string, timestamp long, batchId long").alias("e")
    entries = spark.read.text(pages).filter(F.col("value").startswith("{")).select(entry).select("e.*")
    wanted = entries.filter(F.col("batchId").between(first, last)).distinct()
    return [(r.path, r.timestamp) for r in wanted.collect()]


def check_files(spark: SparkSession, checkpoint: str, batch: int) -> None:
    """Fail if a file of the batch has gone, unless a reload has replaced it.

    A file that goes later fails the batch when it is read.
    """
    gone = lost(spark, batch_files(spark, checkpoint, batch))
    if gone:
        raise FileNotFoundError(f"{len(gone)} files have gone without a replacement: {sorted(gone)[:10]}")


def drain(
    stream: DataFrame,
    checkpoint: str,
    write: Callable[[DataFrame, int], None],
    mode: str = "append",
) -> None:
    """Process everything available, then stop; the checkpoint remembers the place.

    No batch is written before its files are known to be there."""

    def checked(df: DataFrame, batch: int) -> None:
        check_files(df.sparkSession, checkpoint, batch)
        write(df, batch)

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(checked)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_folder(table: str, batch: int) -> str:
    return f"{table}/{BATCH}={batch}"


def write_batch(df: DataFrame, table: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(batch_folder(table, batch))


def read_batches(spark: SparkSession, table: str, schema: StructType | None = None) -> DataFrame:
    """All rows a stream has written, without the batch they came in."""
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    return reader.option("basePath", table).parquet(table).drop(BATCH)


def flow(stream: DataFrame, checkpoint: str, table: str, step: Step) -> None:
    """A stateless chain of steps into one append-only table."""
    drain(stream, checkpoint, lambda df, batch: write_batch(step(df), table, batch))


def refine(
    stream: DataFrame,
    checkpoint: str,
    typed: Step,
    rules: Sequence[Rule],
    onward: Step,
    clean_table: str,
    audit_table: str,
    names: tuple[str, str, str],
    then: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Type, check, and split each batch into clean rows and audit records.

    A violated fail rule stops the run before the batch writes anything. The check and the
    audit read the columns of their rules only, so a batch is not kept: its files are
    fixed, and one that has gone fails the batch. ``then`` gets the clean rows as they were
    written, and the number of the batch.
    """

    def write(df: DataFrame, batch: int) -> None:
        rows = typed(df)
        check_fail_rules(rows, rules)
        assessed = assess(rows, rules)
        write_batch(onward(clean_rows(assessed)), clean_table, batch)
        write_batch(audit_records(assessed, *names), audit_table, batch)
        if then is not None:
            then(df.sparkSession.read.parquet(batch_folder(clean_table, batch)), batch)

    drain(stream, checkpoint, write)


def follow(stream: DataFrame, checkpoint: str, table: Maintained, feed: str) -> None:
    """Keep a type 1 or type 2 table up to date; a batch costs what its changes touch."""
    drain(stream, checkpoint, lambda df, batch: apply_changes(table, df, feed, batch))


def follow_latest(
    stream: DataFrame, checkpoint: str, table: str, keys: Sequence[str], sequence: str, tie: str
) -> None:
    """Type 1 upsert: the state store holds the latest change per key by sequence.

    Late changes never replace newer ones. Each batch writes the keys that changed;
    rows of a key are reduced before the shuffle, so a hot key costs one row per task.
    """
    position = F.struct(F.col(sequence), F.col(tie), row_hash(stream))
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    latest = stream.groupBy(*keys).agg(F.max_by(row, position).alias("__row")).select("__row.*")
    drain(latest, checkpoint, lambda df, batch: write_batch(df, table, batch), mode="update")


def latest_state(
    spark: SparkSession, table: str, keys: Sequence[str], sequence: str, tie: str
) -> DataFrame:
    """The type 1 table from what :func:`follow_latest` has written."""
    return scd1(read_batches(spark, table), keys, sequence, tie)


def follow_changes(stream: DataFrame, checkpoint: str, table: str) -> None:
    """Type 2 feed: changes are appended in any order; a batch costs its own size."""
    flow(stream, checkpoint, table, lambda df: df)


def history_state(
    spark: SparkSession, table: str, keys: Sequence[str], sequence: str, tie: str, **options
) -> DataFrame:
    """The type 2 versions of everything :func:`follow_changes` has written so far.

    A change that arrived late, or twice, takes its place by sequence."""
    return scd2(read_batches(spark, table), keys, sequence, tie, **options)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def follow_history(
    stream: DataFrame,
    checkpoint: str,
    log: str,
    table: str,
    keys: Sequence[str],
    sequence: str,
    tie: str,
    present: Step,
    buckets: int = 256,
) -> None:
    """Type 2 upsert: only the buckets of keys that changed are derived and written again.

    Changes are logged by batch and bucket; the presented versions are partitioned by
    bucket and replaced bucket by bucket, in parallel within a bucket. Both come from
    the log, so a batch that runs twice leaves the same table.
    """
    spark = stream.sparkSession

    def write(df: DataFrame, batch: int) -> None:
        rows = df.withColumn(BUCKET, bucket_of(keys, buckets))
        spread = rows.hint("rebalance", F.col(BUCKET))
        spread.write.mode("overwrite").partitionBy(BUCKET).parquet(batch_folder(log, batch))
        reader = spark.read.schema(rows.schema)
        touched = reader.parquet(batch_folder(log, batch)).select(BUCKET).distinct()
        # at most ``buckets`` numbers come to the driver, to prune the log's folders
        numbers = [r[0] for r in touched.collect()]
        if not numbers:
            return
        logged = reader.option("basePath", log).parquet(log).drop(BATCH)
        versions = present(scd2(logged.filter(F.col(BUCKET).isin(numbers)), keys, sequence, tie))
        (
            versions.hint("rebalance", F.col(BUCKET))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(table)
        )

    drain(stream, checkpoint, write)


def read_history(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table).drop(BUCKET)
