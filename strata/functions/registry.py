"""Named functions that transform rules of type ``custom`` may call."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import strip, title_case

ColumnFunction = Callable[[Column], Column]

_REGISTRY: dict[str, ColumnFunction] = {
    "title_case": title_case,
    "strip": strip,
    "title_case_udf": title_case,
    "trim_udf": strip,
    "sample_udf": lambda column: F.lit("sample"),
}


def register(name: str, function: ColumnFunction) -> None:
    _REGISTRY[name] = function


def lookup(name: str) -> ColumnFunction:
    if name not in _REGISTRY:
        raise KeyError(f"no custom function named {name!r}; known: {sorted(_REGISTRY)}")
    return _REGISTRY[name]
