"""Source to target mapping as data: one projection per (source system, target)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EntityMapping:
    """``rename``: source -> target name. ``derive``: target -> expression over source names.

    Columns named in neither, and not in ``drop``, pass through unchanged.
    """

    rename: Mapping[str, str] = field(default_factory=dict)
    derive: Mapping[str, Column] = field(default_factory=dict)
    drop: Sequence[str] = ()


def map_entity(df: DataFrame, mapping: EntityMapping) -> DataFrame:
    rename = {k.lower(): v for k, v in mapping.rename.items()}
    gone = {c.lower() for c in mapping.drop}
    made = {c.lower() for c in mapping.derive}
    kept = []
    for column in df.columns:
        target = rename.get(column.lower(), column)
        if column.lower() not in gone and target.lower() not in made:
            kept.append(F.col(f"`{column}`").alias(target))
    return df.select(*kept, *[expr.alias(name) for name, expr in mapping.derive.items()])


def choose_mapping(
    mappings: Mapping[tuple[str, str], EntityMapping], source_system: str, target: str
) -> EntityMapping:
    for (system, table), mapping in mappings.items():
        if (system.lower(), table.lower()) == (source_system.lower(), target.lower()):
            return mapping
    raise KeyError(f"no mapping from {source_system!r} to {target!r}")


def rename_existing(df: DataFrame, names: Mapping[str, str], where: str | None = None) -> DataFrame:
    """Select the listed columns that exist under their new names, then filter."""
    present = {c.lower() for c in df.columns}
    out = df.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items() if a.lower() in present])
    return out.filter(F.expr(where)) if where else out


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All sources of one entity, matched by name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
