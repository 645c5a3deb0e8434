"""Tables derived by key from maintained tables; only the keys that changed are built again.

A derived table (a gold timeline) is a base and the deltas after it. A refresh asks its inputs
which keys their commits have touched since the last one, builds the rows of those keys from
the inputs' rows of those keys, and commits them with the list of keys. A row is hidden once
its key stands in a later list, so a key that has no rows any more is gone as well. What a
refresh builds, shuffles and writes grows with the keys that changed, not with the table.

The rows of a key must follow from the inputs' rows of that key alone. After a change of the
build itself, ``whole=True`` builds all keys anew. Deltas are merged, folded and published as
in :mod:`strata.sources.maintained`; a table has one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.sources.files import names_in, publish_text, read_text, remove
from strata.sources.maintained import FOLD, MANY, Maintained, changed_keys, current, read_commit

BUILT = "__built"

Build = Callable[..., DataFrame]


@dataclass(frozen=True)
class Rebuilt:
    """Where a derived table is, and the columns by which it is built."""

    root: str
    keys: Sequence[str]
    many: int = MANY
    fold: float = FOLD


@dataclass(frozen=True)
class State:
    """What makes up a derived table, and the commits of its inputs that it shows."""

    number: int
    schema: str
    inputs: dict[str, int]
    base: str
    base_rows: int = 0
    deltas: list[int] = field(default_factory=list)
    delta_rows: int = 0

    @property
    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def states(spark: SparkSession, table: Rebuilt) -> list[int]:
    names = names_in(spark, f"{table.root}/commits")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def read_state(spark: SparkSession, table: Rebuilt, number: int | None = None) -> State | None:
    """A state, without a number the last; ``None`` before the first."""
    known = states(spark, table)
    if not known or number is not None and number not in known:
        return None
    return State(**json.loads(read_text(spark, f"{table.root}/commits/{number or known[-1]}.json")))


def _publish(spark: SparkSession, table: Rebuilt, state: State) -> State:
    publish_text(spark, f"{table.root}/commits/{state.number}.json", json.dumps(asdict(state)))
    return state


def _write(spark: SparkSession, df: DataFrame, place: str) -> int:
    """Write a folder, over what a run left there that failed before its commit; its rows."""
    df.write.mode("overwrite").parquet(place)
    return spark.read.schema(df.schema).parquet(place).count()


def _with_built(columns: StructType) -> StructType:
    return StructType([*columns.fields, StructField(BUILT, LongType())])


def _lists(spark: SparkSession, table: Rebuilt, state: State) -> DataFrame:
    """Every key that was built after the base, with the number of its last build."""
    keys = StructType([state.columns[k] for k in table.keys])
    rows = spark.read.schema(_with_built(keys)).parquet(*[f"{table.root}/keys-{n}" for n in state.deltas])
    return rows.groupBy(*table.keys).agg(F.max(BUILT).alias(BUILT))


def _same(table: Rebuilt, left: DataFrame, right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, (left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in table.keys))


def _late(spark: SparkSession, table: Rebuilt, state: State) -> DataFrame:
    """Rows of the last build of each key that was built after the base."""
    lists = _lists(spark, table, state)
    rows = spark.read.schema(_with_built(state.columns)).parquet(*[f"{table.root}/delta-{n}" for n in state.deltas])
    return rows.join(lists, _same(table, rows, lists) & (rows[BUILT] == lists[BUILT]), "left_semi")


def _shown(spark: SparkSession, table: Rebuilt, state: State) -> DataFrame:
    base = spark.read.schema(state.columns).parquet(f"{table.root}/{state.base}")
    if not state.deltas:
        return base
    lists = _lists(spark, table, state)
    kept = base.join(lists, _same(table, base, lists), "left_anti")
    return kept.unionByName(_late(spark, table, state).drop(BUILT))


def _grown(known: StructType, new: StructType) -> StructType:
    """The known columns and those that a build brings in addition."""
    types = {f.name: f.dataType for f in known}
    for column in new:
        if types.setdefault(column.name, column.dataType) != column.dataType:
            raise TypeError(f"{column.name} is {types[column.name].simpleString()}, not {column.dataType.simpleString()}")
    return StructType([StructField(n, t) for n, t in types.items()])


def refresh(
    spark: SparkSession, table: Rebuilt, inputs: Mapping[str, Maintained], build: Build, whole: bool = False
) -> State:
    """Bring the table to the last commits of its inputs; ``build`` takes their rows in order.

    Inputs that were committed to after the refresh began are taken up by the next one.
    """
    last, at = read_state(spark, table), {}
    for name, kept in inputs.items():
        commit = read_commit(spark, kept)
        if commit is None:
            raise LookupError(f"{kept.root} has no commit")
        at[name] = commit.number
    number = last.number + 1 if last else 1
    if last is None or whole:
        rows = build(*(current(spark, kept, at[name]) for name, kept in inputs.items()))
        count = _write(spark, rows, f"{table.root}/base-{number}")
        return _publish(spark, table, State(number, rows.schema.json(), at, f"base-{number}", count))
    if set(last.inputs) != set(at):
        raise ValueError(f"{table.root} is built from {sorted(last.inputs)}, not {sorted(at)}")
    moved = [name for name in at if at[name] != last.inputs[name]]
    if not moved:
        return last
    found = [changed_keys(spark, inputs[n], last.inputs[n], table.keys, at[n]) for n in moved]
    touched = reduce(DataFrame.unionByName, found).distinct().withColumn(BUILT, F.lit(number).cast("long"))
    place = f"{table.root}/keys-{number}"
    if not _write(spark, touched, place):
        return _publish(spark, table, replace(last, number=number, inputs=at))
    only = spark.read.schema(touched.schema).parquet(place).drop(BUILT)
    rows = build(*(current(spark, kept, at[name], only) for name, kept in inputs.items()))
    columns = _grown(last.columns, rows.schema)
    rows = rows.withColumn(BUILT, F.lit(number).cast("long"))
    count = _write(spark, rows, f"{table.root}/delta-{number}")
    state = _publish(spark, table, replace(
        last, number=number, schema=columns.json(), inputs=at, deltas=[*last.deltas, number],
        delta_rows=last.delta_rows + count,
    ))
    if state.delta_rows > table.fold * state.base_rows:
        return compact(spark, table)
    return merge_deltas(spark, table) if len(state.deltas) >= table.many else state


def compact(spark: SparkSession, table: Rebuilt) -> State | None:
    """Fold all deltas into a new base."""
    last = read_state(spark, table)
    if last is None or not last.deltas:
        return last
    number = last.number + 1
    count = _write(spark, _shown(spark, table, last), f"{table.root}/base-{number}")
    return _publish(
        spark, table, replace(last, number=number, base=f"base-{number}", base_rows=count, deltas=[], delta_rows=0)
    )


def merge_deltas(spark: SparkSession, table: Rebuilt) -> State | None:
    """Put one delta, with one list of keys, in the place of all."""
    last = read_state(spark, table)
    if last is None or len(last.deltas) < 2:
        return last
    number = last.number + 1
    _write(spark, _lists(spark, table, last), f"{table.root}/keys-{number}")
    count = _write(spark, _late(spark, table, last), f"{table.root}/delta-{number}")
    return _publish(spark, table, replace(last, number=number, deltas=[number], delta_rows=count))


def shown(spark: SparkSession, table: Rebuilt, number: int | None = None) -> DataFrame:
    """The table as of a state, without a number the last."""
    state = read_state(spark, table, number)
    if state is None:
        raise LookupError(f"{table.root} has no commit{'' if number is None else f' {number}'}")
    return _shown(spark, table, state)


def expire(spark: SparkSession, table: Rebuilt, keep: int = 2) -> list[str]:
    """Remove what only states before the last ``keep`` need; returns what has gone."""
    known = states(spark, table)
    old, recent = known[:-keep], known[-keep:]
    needed: set[str] = set()
    for number in recent:
        state = read_state(spark, table, number)
        needed |= {state.base, *(f"{kind}-{n}" for n in state.deltas for kind in ("delta", "keys"))}
    folders = [n for n in names_in(spark, table.root) if n.startswith(("base-", "delta-", "keys-"))]
    # a folder beyond the last state belongs to one that is being written
    gone = [n for n in folders if n not in needed and int(n.split("-")[1]) <= known[-1]] if known else []
    for name in (*(f"commits/{n}.json" for n in old), *gone):
        remove(spark, f"{table.root}/{name}")
    return gone
