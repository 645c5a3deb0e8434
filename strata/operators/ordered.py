"""Ordered look-back and look-ahead that survive hot keys.

A plain ``lag``/``lead`` sends every row of a key to one task. Here the order is
given as levels from coarse to fine (for example day, block of sequence numbers,
sequence number). A window only ever covers one fine group; the value that
crosses a group border is looked up on one summary row per group. With levels
whose groups are bounded (days of a calendar, 65,536 numbers of a block) no task
holds more than that, however many rows one key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_VALUE, _IS_ROW = "__value", "__is_row"
BLOCK_BITS = 16


def block(column: str | Column) -> Column:
    """Number of the 65,536-wide block a long sequence number falls in."""
    return F.shiftright(F.col(column) if isinstance(column, str) else column, BLOCK_BITS)


def nearest(
    df: DataFrame,
    keys: Sequence[str],
    levels: Sequence[str],
    value: Column,
    out: str,
    after: bool = False,
    inclusive: bool = False,
) -> DataFrame:
    """Add ``out``: the nearest non-null ``value`` before (or after) each row.

    ``levels`` orders the rows of a key, coarse to fine. ``inclusive`` lets a row
    see its own value. Wrap a value in a struct when NULL itself must be carried.
    """
    *coarse, fine = levels
    group = [*keys, *coarse]
    rows = df.withColumn(_VALUE, value)
    ahead = F.col(fine).desc() if after else F.col(fine).asc()

    if not coarse:
        window = Window.partitionBy(*group).orderBy(ahead)
    else:
        pick = F.min_by if after else F.max_by
        ends = rows.groupBy(*group).agg(
            pick(_VALUE, F.when(F.col(_VALUE).isNotNull(), F.col(fine))).alias("__end")
        )
        seed = nearest(ends, keys, coarse, F.col("__end"), _VALUE, after=after)
        # the carried value enters the group as one extra first row, so no join is needed
        rows = rows.withColumn(_IS_ROW, F.lit(1)).unionByName(
            seed.select(*group, _VALUE, F.lit(0).alias(_IS_ROW)), allowMissingColumns=True
        )
        window = Window.partitionBy(*group).orderBy(F.col(_IS_ROW), ahead)

    frame = window.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    result = rows.withColumn(out, F.last(_VALUE, ignorenulls=True).over(frame))
    if coarse:
        result = result.filter(F.col(_IS_ROW) == 1).drop(_IS_ROW)
    return result if out == _VALUE else result.drop(_VALUE)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: int = 1
) -> DataFrame:
    """First ``keep`` rows per key in ``order``.

    Catalyst places a group limit in front of the shuffle, so a hot key sends at
    most ``keep`` rows per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rn", F.row_number().over(window))
        .filter(F.col("__rn") <= keep)
        .drop("__rn")
    )


def fingerprint(columns: Sequence[Column]) -> Column:
    """64-bit hash of values and of which of them are NULL (a hash alone skips NULLs)."""
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def row_hash(df: DataFrame) -> Column:
    """Content hash used only to break ties the same way on every run."""
    return fingerprint([F.col(f"`{c}`") for c in sorted(df.columns)])
