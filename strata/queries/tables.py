"""Access to the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day(column: str) -> Column:
    return F.col(column).cast("date")


def month(column: str) -> Column:
    return F.trunc(F.col(column).cast("date"), "month")
