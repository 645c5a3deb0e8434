"""Typed bronze rows from raw landing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.parsing import load_timestamp, mixed_date


def clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def to_bronze(
    landing: DataFrame,
    required: Sequence[str],
    processing_time: int,
    global_columns: Mapping[str, str] | None = None,
    additional_columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Contract columns only, dates parsed, run columns stamped, headers cleaned.

    A missing contract column is an error of the analyzer, before any task runs.
    """
    typed = {
        "loadtimestamp": load_timestamp(F.col("loadtimestamp")),
        "business_date": mixed_date(F.col("business_date")),
    }
    stamped = {
        name: F.lit(processing_time).cast(kind)
        for name, kind in (global_columns or {"processing_time": "long"}).items()
    }
    extra = {name: F.col(f"`{name}`").cast(kind) for name, kind in (additional_columns or {}).items()}
    chosen = landing.select(*[F.col(f"`{c}`") for c in required])
    present = {c: e for c, e in typed.items() if c in chosen.columns}
    return clean_headers(chosen.withColumns({**present, **stamped, **extra}))
