"""Compare a query with its SQL twin: columns, type families, and the bag of rows."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if value != value else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _family(kind: str) -> str:
    kind = str(kind).lower().split("(")[0]
    names = {
        "int": "integer", "smallint": "integer", "tinyint": "integer", "integer": "integer",
        "bigint": "bigint", "hugeint": "hugeint", "varchar": "string", "string": "string",
        "double": "float", "decimal": "decimal", "float": "float", "boolean": "boolean",
        "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
    }
    return names.get(kind, kind)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.sql(sql)
    names, kinds = list(result.columns), [_family(t) for t in result.types]
    expected = result.fetchall()
    mine = {f.name: _family(f.dataType.simpleString()) for f in df.schema.fields}
    if sorted(mine) != sorted(names):
        return [f"columns {sorted(mine)} against {sorted(names)}"]
    found = [f"{n}: type {mine[n]} against {k}" for n, k in zip(names, kinds) if mine[n] != k]
    order = sorted(names)
    at = [names.index(n) for n in order]
    want = Counter(tuple(_plain(row[i]) for i in at) for row in expected)
    have = Counter(tuple(_plain(row[n]) for n in order) for row in df.collect())
    if want != have:
        missing, extra = want - have, have - want
        found.append(f"rows {sum(have.values())} against {sum(want.values())}")
        found.append(f"only in sql {list(missing.items())[:3]}")
        found.append(f"only in spark {list(extra.items())[:3]}")
    return found
