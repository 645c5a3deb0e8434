"""Type 1 and type 2 tables that are kept up to date by commits.

A table is a base and the deltas that were committed after it. A commit costs what its changes
touch, not the table: a type 1 delta holds the latest change of each of its keys; a type 2 delta
the new versions and those whose end they moved. Of two rows for one position (key, for type 2
with sequence and tie) the later one holds, so nothing is rewritten in place.

Deltas are merged when there are many, and folded into a new base once they reach a quarter of
it, so a row is rewritten a few times however many commits there are. A small file for each
commit names the folders that make up the table, what every feed has brought, and the columns;
it appears as a whole. Readers see the last commit; one that started earlier keeps its folders
until :func:`expire`. A batch that is run again is recognised by its feed and number. A table
has one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from strata.operators.ordered import latest_per_key, row_hash
from strata.operators.scd import PROCESSING_TIME, scd2
from strata.sources.files import names_in, publish_text, read_text, remove

HASH, COMMIT, END, OPEN = "__hash", "__commit", "__end_at", "__open"
#: deltas that are merged into one, and the share of the base at which they are folded into it
MANY, FOLD = 16, 0.25


@dataclass(frozen=True)
class Maintained:
    """Where a table is, and how its changes are ordered."""

    root: str
    keys: Sequence[str]
    sequence: str
    tie: str = PROCESSING_TIME
    history: bool = False
    many: int = MANY
    fold: float = FOLD

    @property
    def position(self) -> list[str]:
        return [*self.keys, self.sequence, self.tie] if self.history else [*self.keys]


@dataclass(frozen=True)
class Commit:
    """What makes up a table."""

    number: int
    schema: str
    base: str | None = None
    base_rows: int = 0
    deltas: list[str] = field(default_factory=list)
    delta_rows: int = 0
    fed: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def commits(spark: SparkSession, table: Maintained) -> list[int]:
    names = names_in(spark, f"{table.root}/commits")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def read_commit(spark: SparkSession, table: Maintained, number: int | None = None) -> Commit | None:
    """A commit, without a number the last; ``None`` before the first."""
    known = commits(spark, table)
    if not known or number is not None and number not in known:
        return None
    return Commit(**json.loads(read_text(spark, f"{table.root}/commits/{number or known[-1]}.json")))


def _publish(spark: SparkSession, table: Maintained, commit: Commit) -> Commit:
    publish_text(spark, f"{table.root}/commits/{commit.number}.json", json.dumps(asdict(commit)))
    return commit


def _same(columns: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"`{c}`").eqNullSafe(F.col(f"`{prefix}{c}`")) for c in columns))


def _prefixed(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in columns])


def _rows(spark: SparkSession, table: Maintained, commit: Commit, folders: Sequence[str]) -> DataFrame:
    columns = commit.columns
    if table.history and [*folders] == [commit.base]:
        columns = columns.add(OPEN, IntegerType())
    reader = spark.read.schema(columns)
    return reader.parquet(*[f"{table.root}/{f}" for f in folders])


def _newest(table: Maintained, rows: DataFrame) -> DataFrame:
    """One row for each position."""
    if table.history:
        order = [F.col(COMMIT).desc()]
    else:
        order = [F.col(table.sequence).desc(), F.col(table.tie).desc(), F.col(HASH).desc()]
    return latest_per_key(rows, table.position, order)


def _current(
    spark: SparkSession, table: Maintained, commit: Commit, since=None, only: DataFrame | None = None
) -> DataFrame:
    """Rows of a commit, with the columns of its upkeep.

    ``since`` leaves out versions that ended before it; the base is pruned by it. ``only``
    lists values of some key columns; other keys are left out before anything is shuffled.
    """

    def late(df: DataFrame) -> DataFrame:
        return df if since is None else df.where(F.col(END).isNull() | (F.col(END) >= F.lit(since)))

    def read(folders: Sequence[str]) -> DataFrame:
        rows = _rows(spark, table, commit, folders)
        if only is None:
            return rows
        return rows.join(_prefixed(only, only.columns, "o_"), _same(only.columns, "o_"), "left_semi")

    base = None
    if commit.base:
        base = read([commit.base])
        if table.history:
            # two scans, so that folders and row groups can be left out
            closed = base.where(F.col(OPEN) == 0)
            closed = closed if since is None else closed.where(F.col(END) >= F.lit(since))
            base = base.where(F.col(OPEN) == 1).unionByName(closed).drop(OPEN)
    if not commit.deltas:
        return base
    # a single type 1 delta holds no key twice
    alone = len(commit.deltas) == 1 and not table.history
    newest = read(commit.deltas) if alone else _newest(table, read(commit.deltas))
    if base is None:
        return late(newest)
    if not table.history:
        return _newest(table, base.unionByName(newest))
    stale = _prefixed(newest, table.position, "d_")
    kept = base.join(stale, _same(table.position, "d_"), "left_anti")
    return kept.unionByName(late(newest))


def _moved(spark: SparkSession, table: Maintained, commit: Commit | None, changes: DataFrame) -> DataFrame:
    """Versions of the changes, and known ones whose end they move.

    Of a key only the version that its first change falls into, and later ones, are read: in
    order, that is the open one.
    """
    new = latest_per_key(changes, table.position, [F.col(HASH).desc()])
    new = new.withColumn("__old", F.lit(False)).withColumn("__was", F.lit(None).cast(changes.schema[table.sequence].dataType))
    if commit is not None:
        low = changes.agg(F.min(table.sequence)).first()[0]
        firsts = changes.groupBy(*table.keys).agg(F.min(table.sequence).alias("__first"))
        firsts = _prefixed(firsts, [*table.keys, "__first"], "f_")
        known = _current(spark, table, commit, low).drop(COMMIT)
        touched = _same(table.keys, "f_") & (F.col(END).isNull() | (F.col(END) >= F.col("f___first")))
        old = known.join(firsts, touched).select(*[F.col(f"`{c}`") for c in known.columns])
        old = old.withColumnRenamed(END, "__was").withColumn("__old", F.lit(True))
        both = old.unionByName(new, allowMissingColumns=True)
        # the same position with other content: the greater hash, as in a batch
        new = latest_per_key(both, table.position, [F.col(HASH).desc(), F.col("__old").desc()])
    versions = scd2(new, table.keys, table.sequence, table.tie, unique=True)
    moved = ~F.col("__old") | ~F.col("end_at").eqNullSafe(F.col("__was"))
    return versions.where(moved).withColumnRenamed("end_at", END).drop("start_at", "__old", "__was")


def _merged(known: StructType | None, new: StructType) -> StructType:
    """Columns of the table with those that changes bring in addition."""
    if known is None:
        return new
    types = {f.name: f.dataType for f in known}
    for column in new:
        if types.setdefault(column.name, column.dataType) != column.dataType:
            raise TypeError(f"{column.name} is {types[column.name].simpleString()}, not {column.dataType.simpleString()}")
    return StructType([StructField(n, t) for n, t in types.items()])


def apply_changes(table: Maintained, changes: DataFrame, feed: str, batch: int, size: int | None = None) -> Commit:
    """Commit a batch of changes; a batch of a feed that was committed before is left out.

    Positions are (sequence, tie) within a key. Late changes take their place, equal
    positions are settled by a content hash, as in :mod:`strata.operators.scd`. Where the
    ``size`` of the batch is known, one for which a type 1 table would be folded goes into
    the new base at once, without a delta.
    """
    spark = changes.sparkSession
    last = read_commit(spark, table)
    if last and last.fed.get(feed, -1) >= batch:
        return last
    rows = changes.withColumn(HASH, row_hash(changes))
    if last:
        _merged(last.columns, rows.schema)
        large = size is not None and last.delta_rows + size > table.fold * last.base_rows
        if large and last.base and not table.history:
            return _fold(spark, table, last, rows, {**last.fed, feed: batch})
    if table.history:
        delta = _moved(spark, table, last, rows)
    else:
        delta = _newest(table, rows)
    number = last.number + 1 if last else 1
    delta = delta.withColumn(COMMIT, F.lit(number).cast("long"))
    columns = _merged(last.columns if last else None, delta.schema)
    folder = f"delta-{number}"
    # left by a run that failed before its commit, if it is there
    delta.write.mode("overwrite").parquet(f"{table.root}/{folder}")
    count = spark.read.schema(delta.schema).parquet(f"{table.root}/{folder}").count()
    before = last or Commit(0, "")
    commit = replace(
        before,
        number=number,
        schema=columns.json(),
        deltas=[*before.deltas, folder],
        delta_rows=before.delta_rows + count,
        fed={**before.fed, feed: batch},
    )
    _publish(spark, table, commit)
    if commit.delta_rows > table.fold * commit.base_rows:
        return compact(spark, table)
    return merge_deltas(spark, table) if len(commit.deltas) >= table.many else commit


def _fold(spark: SparkSession, table: Maintained, last: Commit, rows: DataFrame, fed: dict[str, int]) -> Commit:
    """Write a type 1 table and a batch of its changes as a new base."""
    number = last.number + 1
    rows = rows.withColumn(COMMIT, F.lit(number).cast("long"))
    columns = _merged(last.columns, rows.schema)
    both = _current(spark, table, last).unionByName(rows, allowMissingColumns=True)
    folder = f"base-{number}"
    kept = _newest(table, both.select(*[F.col(f"`{c}`") for c in columns.names]))
    kept.write.mode("overwrite").parquet(f"{table.root}/{folder}")
    count = spark.read.schema(columns).parquet(f"{table.root}/{folder}").count()
    commit = Commit(number, columns.json(), folder, count, [], 0, fed)
    return _publish(spark, table, commit)


def compact(spark: SparkSession, table: Maintained) -> Commit | None:
    """Fold all deltas into a new base."""
    last = read_commit(spark, table)
    if last is None or not last.deltas:
        return last
    if last.base is None and len(last.deltas) == 1 and not table.history:
        # a type 1 base is laid out as a delta is, so the first delta becomes the base
        first = replace(last, base=last.deltas[0], base_rows=last.delta_rows, deltas=[], delta_rows=0)
        return _publish(spark, table, replace(first, number=last.number + 1))
    folder = f"base-{last.number + 1}"
    rows = _current(spark, table, last)
    writer = rows.write
    if table.history:
        rows = rows.withColumn(OPEN, F.col(END).isNull().cast("int")).hint("rebalance", F.col(OPEN))
        writer = rows.sortWithinPartitions(OPEN, END).write.partitionBy(OPEN)
    writer.mode("overwrite").parquet(f"{table.root}/{folder}")
    count = spark.read.schema(StructType([StructField(COMMIT, LongType())])).parquet(f"{table.root}/{folder}").count()
    commit = replace(last, number=last.number + 1, base=folder, base_rows=count, deltas=[], delta_rows=0)
    return _publish(spark, table, commit)


def merge_deltas(spark: SparkSession, table: Maintained) -> Commit:
    """Put one delta in the place of all."""
    last = read_commit(spark, table)
    folder = f"delta-{last.number + 1}"
    _newest(table, _rows(spark, table, last, last.deltas)).write.mode("overwrite").parquet(f"{table.root}/{folder}")
    count = spark.read.schema(last.columns).parquet(f"{table.root}/{folder}").count()
    return _publish(spark, table, replace(last, number=last.number + 1, deltas=[folder], delta_rows=count))


def expire(spark: SparkSession, table: Maintained, keep: int = 2) -> list[str]:
    """Remove what only commits before the last ``keep`` need; returns what has gone."""
    known = commits(spark, table)
    old, recent = known[:-keep], known[-keep:]
    needed = set()
    for number in recent:
        commit = read_commit(spark, table, number)
        needed |= {commit.base, *commit.deltas}
    folders = [n for n in names_in(spark, table.root) if n.startswith(("base-", "delta-"))]
    # a folder beyond the last commit belongs to one that is being written
    gone = [n for n in folders if n not in needed and int(n.split("-")[1]) <= known[-1]] if known else []
    for name in (*(f"commits/{n}.json" for n in old), *gone):
        remove(spark, f"{table.root}/{name}")
    return gone


def changed_keys(
    spark: SparkSession, table: Maintained, since: int, columns: Sequence[str] | None = None, number: int | None = None
) -> DataFrame:
    """Keys, or some of their columns, of all rows that commits after ``since`` have brought or moved.

    Folders that were written up to ``since`` are not read; of later ones that hold older rows
    too, row groups are left out by the commit number of their rows.
    """
    columns = [*(columns or table.keys)]
    if not set(columns) <= set(table.keys):
        raise ValueError(f"{columns} are not key columns of {table.root}")
    commit = read_commit(spark, table, number)
    if commit is None:
        raise LookupError(f"{table.root} has no commit{'' if number is None else f' {number}'}")
    written = [f for f in (commit.base, *commit.deltas) if f and int(f.split("-")[1]) > since]
    # a base may have folders of its own, deltas have none
    parts = [p for p in ([f for f in written if f == commit.base], [f for f in written if f != commit.base]) if p]
    if not parts:
        return spark.createDataFrame([], StructType([commit.columns[c] for c in columns]))
    later = [_rows(spark, table, commit, p).where(F.col(COMMIT) > since).select(*columns) for p in parts]
    return reduce(DataFrame.unionByName, later).distinct()


def current(
    spark: SparkSession, table: Maintained, number: int | None = None, only: DataFrame | None = None
) -> DataFrame:
    """The table as of a commit, without a number the last: for type 1 the latest change of each
    key, for type 2 all versions with ``start_at`` and ``end_at``. ``only`` lists the values of
    some key columns whose rows are wanted."""
    commit = read_commit(spark, table, number)
    if commit is None:
        raise LookupError(f"{table.root} has no commit{'' if number is None else f' {number}'}")
    rows = _current(spark, table, commit, only=only).drop(HASH, COMMIT)
    if not table.history:
        return rows
    return rows.withColumn("start_at", F.col(table.sequence)).withColumnRenamed(END, "end_at")
