"""Validity timelines: slice, align, collapse, trim.

Intervals are half-open dates ``[start, end)`` until :func:`trim`, which closes them.
After duplicates are removed a key has at most one slice per calendar day, so windows
over slices are bounded by the calendar and not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.ordered import fingerprint, nearest


@dataclass(frozen=True)
class Intervals:
    """A frame of versions with its key and validity columns."""

    frame: DataFrame
    keys: Sequence[str]
    start: str
    end: str
    where: str | None = None

    def rows(self) -> DataFrame:
        """Versions that pass the filter, with their validity as dates."""
        chosen = self.frame.filter(F.expr(self.where)) if self.where else self.frame
        return chosen.withColumns(
            {self.start: F.col(self.start).cast("date"), self.end: F.col(self.end).cast("date")}
        )

    def boundaries(self) -> DataFrame:
        both = F.array(F.col(self.start), F.col(self.end))
        return self.rows().select(*self.keys, F.explode(both).alias("boundary"))


def dealt(df: DataFrame, columns: Sequence[str], parts: int | None) -> DataFrame:
    """Rows by ``columns`` in so many partitions; without a number it stays with the planner."""
    return df if parts is None else df.repartition(parts, *columns)


def slices(
    tables: Sequence[Intervals], start: str = "slice_start", end: str = "slice_end", parts: int | None = None
) -> DataFrame:
    """Consecutive slices between all boundary dates a key has in any table.

    Each table is read once. Boundaries are made distinct before the shuffle, which has
    ``parts`` partitions if that is given.
    """
    keys = list(tables[0].keys)
    points = reduce(
        lambda a, b: a.unionByName(b),
        [t.boundaries().toDF(*keys, "boundary") for t in tables],
    )
    points = dealt(points.filter(F.col("boundary").isNotNull()).distinct(), keys, parts)
    following = F.lead("boundary").over(Window.partitionBy(*keys).orderBy("boundary"))
    return (
        points.select(*keys, F.col("boundary").alias(start), following.alias(end))
        .filter(F.col(end).isNotNull())
    )


def align(
    sliced: DataFrame,
    tables: Sequence[tuple[Intervals, Sequence[str]]],
    start: str = "slice_start",
    end: str = "slice_end",
    outer: bool = False,
    unique: bool = False,
    years: int = 10,
    parts: int | None = None,
) -> DataFrame:
    """Attach the columns of every version, of each table in turn, that contains a slice.

    Both sides are cut by year as well as key: candidates are compared within one
    year only and a hot key spreads over its years. Years before and after the last
    ``years`` of the first table share one part each, so an open or ancient end costs
    few extra rows; any choice gives the same result. All joins share the cut, so the
    slices are shuffled once, to ``parts`` partitions if that is given. ``unique`` states
    that no table repeats a version.
    """
    keys = list(tables[0][0].keys)
    newest = tables[0][0].rows().agg(F.max(tables[0][0].start)).scalar()
    last = F.year(F.least(newest, F.current_date()))

    def year_part(day: Column) -> Column:
        return F.greatest(F.least(F.year(day), last), last - years)

    found = dealt(sliced.withColumn("__at", year_part(F.col(start))), [*keys, "__at"], parts)
    for versions, columns in tables:
        rows = versions.rows().filter(F.col(versions.start) < F.col(versions.end))
        rows = rows.select(
            *[F.col(k).alias(f"v_{k}") for k in versions.keys],
            F.col(versions.start).alias("__eff"),
            F.col(versions.end).alias("__term"),
            *columns,
        )
        rows = rows if unique else rows.distinct()
        covered = F.sequence(year_part(F.col("__eff")), year_part(F.date_sub("__term", 1)))
        rows = rows.withColumn("__part", F.explode(covered))
        same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"v_{k}") for k in keys])
        inside = (F.col(start) >= F.col("__eff")) & (F.col(end) <= F.col("__term"))
        on = same & (F.col("__at") == F.col("__part")) & inside
        joined = found.join(rows, on, "left" if outer else "inner")
        found = joined.select(*found.columns, *columns)
    return found.drop("__at")


def _never(flag: str, versions: Intervals) -> Column:
    """True, or an error where versions of a key overlap."""
    told = F.raise_error(F.lit(f"versions of {', '.join(versions.keys)} overlap"))
    return F.when(F.col(flag), told.cast("boolean")).otherwise(True)


def align_latest(
    sliced: DataFrame,
    versions: Intervals,
    columns: Sequence[str],
    start: str = "slice_start",
    end: str = "slice_end",
) -> DataFrame:
    """Like :func:`align` for versions that do not overlap within a key: one linear
    pass over slices and versions in date order, no pairs. Overlapping versions fail."""
    keys = list(versions.keys)
    rows = versions.rows().filter(F.col(versions.start) < F.col(versions.end))
    held = F.struct(F.col(versions.end).alias("__term"), *[F.col(c) for c in columns])
    known = rows.select(
        *keys, F.col(versions.start).alias("__at"), held.alias("__held"), F.lit(0).alias("__slice")
    )
    asked = sliced.withColumns({"__at": F.col(start), "__slice": F.lit(1)})
    both = asked.unionByName(known, allowMissingColumns=True)
    both = both.withColumn("__pos", F.struct("__at", "__slice"))
    found = nearest(both, keys, ["__pos"], F.col("__held"), "__now", inclusive=True)
    above = Window.partitionBy(*keys).orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.last("__held.__term", ignorenulls=True).over(above)
    found = found.withColumn("__clash", (F.col("__slice") == 0) & (earlier > F.col("__at")))
    # seen from the slices: the optimiser knows that only these are kept
    so_far = above.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("__clash", F.max("__clash").over(so_far)).filter(_never("__clash", versions))
    inside = (F.col("__slice") == 1) & (F.col(end) <= F.col("__now.__term"))
    return found.filter(inside).select(
        *sliced.columns, *[F.col(f"__now.{c}").alias(c) for c in columns]
    )


def timeline(
    tables: Sequence[tuple[Intervals, Sequence[str]]],
    start: str = "slice_start",
    end: str = "slice_end",
) -> DataFrame:
    """Slice and align in one pass, for tables whose versions of a key never overlap.

    Equal to :func:`slices` followed by :func:`align` for each table, with a single
    shuffle by key. Versions that overlap within a key fail the query. Versions that do
    not start on distinct days, so a key brings at most two rows per table and calendar day. A version without length contains no slice and
    its date is a boundary of its neighbours, so it is left out.
    """
    keys = list(tables[0][0].keys)
    marks = []
    for i, (versions, columns) in enumerate(tables):
        rows = versions.rows().filter(F.col(versions.start) < F.col(versions.end))
        held = F.struct(F.col(versions.end).alias("__term"), *[F.col(c) for c in columns])
        opening = F.struct(F.col(versions.start).alias(start), held.alias(f"__held{i}"))
        closing = F.struct(F.col(versions.end).alias(start), F.lit(None).alias(f"__held{i}"))
        marks.append(rows.select(*versions.keys, F.inline(F.array(opening, closing))).toDF(
            *keys, start, f"__held{i}"
        ))
    points = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marks)

    order = Window.partitionBy(*keys).orderBy(start)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    current = [F.last(f"__held{i}", ignorenulls=True).over(so_far) for i in range(len(tables))]
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    clashes = []
    for i in range(len(tables)):
        held = F.last(f"__held{i}", ignorenulls=True).over(earlier)
        opens = F.col(f"__held{i}").isNotNull()
        clashes.append(F.coalesce(opens & (held["__term"] > F.col(start)), F.lit(False)))
    swept = points.select(
        *keys,
        start,
        F.lead(start).over(order).alias(end),
        *[c.alias(f"__now{i}") for i, c in enumerate(current)],
        *[c.alias(f"__clash{i}") for i, c in enumerate(clashes)],
    )
    for i, (versions, _) in enumerate(tables):
        swept = swept.filter(_never(f"__clash{i}", versions))
    # the last mark of a day has seen all marks of that day
    swept = swept.filter(F.col(end) > F.col(start))
    for i in range(len(tables)):
        swept = swept.filter(F.col(end) <= F.col(f"__now{i}.__term"))
    chosen = [F.col(f"__now{i}.{c}").alias(c) for i, (_, cols) in enumerate(tables) for c in cols]
    return swept.select(*keys, start, end, *chosen)


def islands(
    df: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    start: str,
    end: str,
    mode: str = "state",
) -> DataFrame:
    """Merge consecutive slices with equal attributes (NULLs equal).

    ``state``: slices merge when they touch; the island number runs per key and state,
    so one shuffle serves the look-back, the numbering and the grouping.
    ``reference``: a gap of one day is bridged and the island number runs per key.

    Windows sort by a 128-bit fingerprint of the attributes instead of the attributes;
    the grouping uses the attributes themselves, so different states never merge.
    """
    if mode not in ("state", "reference"):
        raise ValueError(f"unknown mode {mode!r}")
    columns = [F.col(c) for c in attributes]
    rows = df.withColumns(
        {"__h1": fingerprint(columns), "__h2": F.xxhash64(F.lit(2), *reversed(columns))}
    )
    state = [*keys, "__h1", "__h2"]
    previous = F.lag(end).over(Window.partitionBy(*state).orderBy(start))
    reach = previous if mode == "state" else F.date_add(previous, 1)
    opens = F.when(previous.isNull() | (F.col(start) > reach), 1).otherwise(0)
    numbering = Window.partitionBy(*(state if mode == "state" else keys)).orderBy(start)
    running = numbering.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("__opens", opens)
        .withColumn("__island", F.sum("__opens").over(running))
        .groupBy(*state, "__island", *attributes)
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("__h1", "__h2", "__island")
    )


def trim(
    df: DataFrame, keys: Sequence[str], start: str, end: str, parallel: Sequence[str] = ()
) -> DataFrame:
    """Close intervals: one that reaches the next start ends the day before it.

    ``parallel`` columns keep separate timelines of one key apart. Rows whose end
    falls before their start are dropped.
    """
    window = Window.partitionBy(*keys, *parallel).orderBy(start)
    following = F.lead(start).over(window)
    closed = F.when(F.col(end) >= following, F.date_sub(following, 1)).otherwise(F.col(end))
    return df.withColumn(end, closed).filter(F.col(start) <= F.col(end))

