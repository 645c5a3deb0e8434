"""Change detection between snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.ordered import latest_per_key, row_hash

OPERATION = "__$operation"
SNAPSHOT_ROW, DELETE = "5", "1"


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    """NULL-safe equality of equally named columns that carry different prefixes."""
    pairs = [F.col(f"`{left}{k}`").eqNullSafe(F.col(f"`{right}{k}`")) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def _prefixed(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in columns])


def live_rows(
    landing: DataFrame, keys: Sequence[str], sequence: Sequence[str], operation: str = OPERATION
) -> DataFrame:
    """Last known row of every key that is not already deleted."""
    order = [F.col(c).desc() for c in sequence] + [row_hash(landing).desc()]
    latest = latest_per_key(landing, keys, order)
    return latest.filter(~F.col(f"`{operation}`").eqNullSafe(F.lit(DELETE)))


def snapshot_deletes(
    snapshot: DataFrame,
    landing: DataFrame | None,
    keys: Sequence[str],
    sequence: Sequence[str] = ("business_date",),
    operation: str = OPERATION,
) -> DataFrame:
    """The snapshot plus one delete row per live key it no longer contains.

    Without a landing table (first load) the snapshot is returned unchanged. A key
    that was deleted before is not deleted again. NULL keys match each other. Keys that the
    snapshot holds leave before the last rows of the others are sought, so only these are
    sorted.
    """
    if operation not in snapshot.columns:
        snapshot = snapshot.withColumn(operation, F.lit(SNAPSHOT_ROW))
    if landing is None:
        return snapshot
    present = _prefixed(snapshot, keys, "n_").distinct()
    absent = landing.join(present, _same(keys, "", "n_"), "left_anti")
    gone = live_rows(absent, keys, sequence, operation).withColumn(operation, F.lit(DELETE))
    shared = [F.col(f"`{c}`") for c in snapshot.columns if c in gone.columns]
    return snapshot.unionByName(gone.select(*shared), allowMissingColumns=True)


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """Classify every key of two snapshots: I(nsert), U(pdate), D(elete) or N(o change).

    Both sides hold a key once. Columns are compared exactly and NULL-safe, no hash
    is involved. A deleted key keeps its old row, every other key shows its new row.
    """
    compare = list(compare or [c for c in new.columns if c not in keys])
    columns = [*keys, *compare]

    a = _prefixed(old, columns, "o_").withColumn("__old", F.lit(True))
    b = _prefixed(new, columns, "n_").withColumn("__new", F.lit(True))
    change = (
        F.when(F.col("__old").isNull(), "I")
        .when(F.col("__new").isNull(), "D")
        .when(_same(compare, "o_", "n_"), "N")
        .otherwise("U")
    )
    shown = [
        F.when(F.col("__new").isNull(), F.col(f"`o_{c}`")).otherwise(F.col(f"`n_{c}`")).alias(c)
        for c in columns
    ]
    joined = a.join(b, _same(keys, "o_", "n_"), "full_outer")
    return joined.select(*shown, change.alias("change"))


def without_operations(df: DataFrame, ignore: Sequence[str], operation: str = OPERATION) -> DataFrame:
    """Leave out codes such as before-images; a missing code stays."""
    if not ignore:
        return df
    code = F.col(f"`{operation}`").cast("string")
    return df.filter(F.coalesce(~code.isin(*ignore), F.lit(True)))
