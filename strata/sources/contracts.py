"""Schema contracts: look-up, snapshots as JSON, drift, and rescue of unexpected fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RESCUED = "rescued_data"


def required_columns(
    contracts: Mapping[tuple[str, str, str], Sequence[str]], source: str, schema: str, table: str
) -> list[str]:
    key = (source, schema, table)
    if key not in contracts:
        raise KeyError(f"no contract for source {source!r}, schema {schema!r}, table {table!r}")
    return list(contracts[key])


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """Stand-in for a landing table that does not exist yet."""
    return spark.createDataFrame([], schema)


def save_schema(df: DataFrame, path: str) -> None:
    """Store the schema as one JSON document."""
    spark = df.sparkSession
    spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def load_schema(spark: SparkSession, path: str) -> StructType:
    import json

    return StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first()[0]))


def drift(expected: StructType, actual: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, expected type, actual type) of every difference, by column name."""
    want = {f.name.lower(): f for f in expected.fields}
    have = {f.name.lower(): f for f in actual.fields}
    found = []
    for name in sorted(want.keys() | have.keys()):
        a = want[name].dataType.simpleString() if name in want else None
        b = have[name].dataType.simpleString() if name in have else None
        if a != b:
            change = "added" if a is None else "missing" if b is None else "retyped"
            found.append((name, change, a, b))
    return found


def rescue(df: DataFrame, expected: StructType, out: str = RESCUED) -> DataFrame:
    """Contract columns in contract types; fields outside the contract go to one JSON column.

    A contract column the data lacks is NULL. Rows without extra values get NULL.
    """
    have = {c.lower(): c for c in df.columns}
    known = [
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in expected.fields
    ]
    names = {f.name.lower() for f in expected.fields}
    extra = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    if not extra:
        return df.select(*known, F.lit(None).cast("string").alias(out))
    body = F.to_json(F.struct(*extra))
    return df.select(*known, F.when(body != "{}", body).alias(out))
