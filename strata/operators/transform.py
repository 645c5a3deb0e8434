"""Rule-driven column transforms, composed into few projections."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.registry import lookup


@dataclass(frozen=True)
class TransformRule:
    """``kind`` is ``default`` (constant), ``custom`` (registered function),
    ``expression`` (free SQL over the row), or anything else for a one-argument SQL function."""

    column: str
    kind: str
    function: str
    order: int | None = None


def apply_transforms(df: DataFrame, rules: Iterable[TransformRule]) -> DataFrame:
    """Apply rules by ``order``, else by position; rules on one column chain.

    Chained rules nest into one expression, so a whole rule set is one projection.
    Only a free expression starts a new one, because it may read changed columns.
    """
    numbered = list(enumerate(rules))
    numbered.sort(key=lambda it: (it[0] if it[1].order is None else it[1].order, it[0]))
    pending: dict[str, Column] = {}
    for _, rule in numbered:
        if not rule.function:
            continue
        kind = rule.kind.strip().lower()
        if kind == "expression":
            df = df.withColumns(pending) if pending else df
            pending = {rule.column: F.expr(rule.function)}
            continue
        current = pending.get(rule.column)
        if kind == "default":
            pending[rule.column] = F.lit(rule.function)
            continue
        current = F.col(f"`{rule.column}`") if current is None else current
        if kind == "custom":
            pending[rule.column] = lookup(rule.function)(current)
        else:
            pending[rule.column] = F.call_function(rule.function, current)
    return df.withColumns(pending) if pending else df


def with_defaults(df: DataFrame, columns: list[str], values: list | dict) -> DataFrame:
    """Set listed columns to constants, given as a list in order or by name."""
    by_name = values if isinstance(values, dict) else dict(zip(columns, values, strict=True))
    return df.withColumns({c: F.lit(by_name[c]) for c in columns if c in by_name})
