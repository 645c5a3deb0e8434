"""Code to label translation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: employee count types and their published names
COUNT_TYPES = {
    "MLRR": "Group Response",
    "MLRP": "Previous Group Response",
    "MLRD": "Default",
}
NO_LABEL = "Not Applicable"


def label(code: Column, labels: Mapping[str, str], default: str = NO_LABEL) -> Column:
    chosen = F.lit(default)
    for key, text in labels.items():
        chosen = F.when(code == key, text).otherwise(chosen)
    return chosen


def deleted_flag(operation: Column, delete_code: str) -> Column:
    """``Y`` for the source's delete code, ``N`` for every other or missing code."""
    return F.when(operation.cast("string") == delete_code, "Y").otherwise("N")
