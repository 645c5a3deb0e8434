"""Type 1 and type 2 history from a change feed, late and out-of-order rows included.

The order of a key's changes is (sequence column, processing time); arrival order
never matters. Equal positions are settled by a content hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.parsing import open_end
from strata.operators.ordered import BLOCK_BITS, block, latest_per_key, nearest, row_hash

PROCESSING_TIME = "processing_time"


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tie: str = PROCESSING_TIME,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """The change with the greatest (sequence, processing time) per key."""
    order = [F.col(sequence).desc(), F.col(tie).desc(), row_hash(changes).desc()]
    return latest_per_key(changes, keys, order).drop(*exclude)


def one_per_position(
    changes: DataFrame, keys: Sequence[str], sequence: str, tie: str = PROCESSING_TIME
) -> DataFrame:
    """Keep one change per key and position, so a position names one version."""
    return latest_per_key(changes, [*keys, sequence, tie], [row_hash(changes).desc()])


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    tie: str = PROCESSING_TIME,
    track: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """One version per change, ending at the sequence of the next change of its key.

    Adds ``start_at`` and ``end_at`` (NULL while open). ``track`` leaves out a change
    that alters none of these columns. ``unique`` states that a position never
    repeats and saves the shuffle that would check it.

    No task holds a key: the dates of a key are made distinct before they meet in a
    window, and the changes of one hot key and date are only joined to that date.
    """
    # repeated positions do not move the steps, so these need not wait for their removal
    stepping = changes
    if not unique:
        changes = one_per_position(changes, keys, sequence, tie)
    if track is not None:
        changes = stepping = _only_changed(changes, keys, sequence, tie, track)
    steps = stepping.groupBy(*keys, sequence).agg(F.max(tie).alias("__last_tie"))
    steps, levels = _calendar_levels(steps, sequence)
    steps = nearest(steps, keys, levels, F.col(sequence), "__next", after=True)
    at = [*keys, sequence]
    steps = steps.select(*[F.col(c).alias(f"s_{c}") for c in at], "__last_tie", "__next")
    on = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in at]
    end = F.when(F.col(tie) < F.col("__last_tie"), F.col(sequence)).otherwise(F.col("__next"))
    return changes.join(steps, on).select(
        *[F.col(f"`{c}`") for c in changes.columns if c not in exclude],
        F.col(sequence).alias("start_at"),
        end.alias("end_at"),
    )


def _only_changed(
    changes: DataFrame, keys: Sequence[str], sequence: str, tie: str, track: Sequence[str]
) -> DataFrame:
    """Drop a change whose tracked columns equal those of the change before it."""
    state = F.struct(*[F.col(f"`{c}`") for c in track])
    rows, levels = _calendar_levels(changes, sequence)
    rows = rows.withColumn("__block", block(F.col(tie).cast("long")))
    rows = nearest(rows, keys, [*levels, "__block", tie], state, "__before")
    changed = F.col("__before").isNull() | ~F.col("__before").eqNullSafe(state)
    return rows.filter(changed).select(*[F.col(f"`{c}`") for c in changes.columns])


def _calendar_levels(df: DataFrame, sequence: str) -> tuple[DataFrame, list[str]]:
    """Order levels of a sequence column, each bounded by the calendar or the clock."""
    if isinstance(df.schema[sequence].dataType, T.DateType):
        return df, [sequence]
    if isinstance(df.schema[sequence].dataType, (T.TimestampType, T.TimestampNTZType)):
        day, second = F.col(sequence).cast("date"), F.date_trunc("second", F.col(sequence))
        return df.withColumns({"__day": day, "__second": second}), ["__day", "__second", sequence]
    number = F.col(sequence).cast("long")
    coarse = {"__blocks": F.shiftright(number, 2 * BLOCK_BITS), "__block_of": block(number)}
    return df.withColumns(coarse), [*coarse, sequence]


def present_scd2(
    versions: DataFrame,
    business_date: str = "business_date",
    deleted: str | None = "Row_Is_Deleted_Ind",
) -> DataFrame:
    """Validity dates and flags of versions made by :func:`scd2`.

    A deleted version ends on its own business date. ``Row_Is_Active_Ind`` marks the
    last version of a key on each business date; ``is_current`` the one still open.
    """
    start, end = F.col("start_at").cast("date"), F.col("end_at").cast("date")
    gone = F.col(deleted) == "Y" if deleted else F.lit(False)
    last_of_date = F.col("end_at").isNull() | (end > start)
    return versions.withColumns(
        {
            "Row_Effective_Date": start,
            "Row_Term_Date": F.when(gone, F.col(business_date)).otherwise(
                F.coalesce(end, open_end())
            ),
            "Row_Is_Active_Ind": F.when(last_of_date, "Y").otherwise("N"),
            "is_current": F.col("end_at").isNull() & ~F.coalesce(gone, F.lit(False)),
        }
    ).drop("start_at", "end_at")


def active_flag(
    versions: DataFrame,
    keys: Sequence[str],
    by_date: Column,
    tie: str = PROCESSING_TIME,
    out: str = "Row_Is_Active_Ind",
) -> DataFrame:
    """``Y`` for every version with the greatest processing time of its key and date.

    The maximum is aggregated ahead of the shuffle and joined back, so versions of one
    hot key and date may be spread over tasks.
    """
    rows = versions.withColumn("__date", by_date)
    group = [*keys, "__date"]
    top = rows.groupBy(*[F.col(c).alias(f"top_{c}") for c in group]).agg(F.max(tie).alias("__top"))
    on = [F.col(c).eqNullSafe(F.col(f"top_{c}")) for c in group]
    flag = F.when(F.col(tie).eqNullSafe(F.col("__top")), "Y").otherwise("N")
    return rows.join(top, on).select(*versions.columns, flag.alias(out))
