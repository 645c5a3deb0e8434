"""What the operators share: documents in Arrow batches of bounded size, and row keys."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import save_and_read

BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Limit what Spark hands to a Python worker at once, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def per_row(
    docs: DataFrame,
    columns: list[str],
    results: str,
    make: Callable[[], Callable[[tuple], Iterable[tuple]]],
) -> DataFrame:
    """Rows made from each row of ``docs``.

    ``make`` runs once per task and returns the function of one row; ``columns`` of type
    string arrive as UTF-8 bytes, and None stays None. ``results`` is the schema of what
    the function yields.
    """
    bound_batches(docs.sparkSession)
    chosen = docs.select(
        *(F.col(c).cast("binary").alias(c) if t == "string" else F.col(c)
          for c, t in docs.select(*columns).dtypes)
    )
    target = arrow_schema(docs.sparkSession, results)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            out = [r for row in zip(*(c.to_pylist() for c in batch.columns)) for r in work(row)]
            yield to_batch(out, target)

    return chosen.mapInArrow(run, results)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema
    )


def squeeze(data: bytes) -> bytes:
    """Text as it is moved and kept between steps: about a third of its size."""
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def unsqueeze(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def text_key(text: str = "text") -> Column:
    """With doc_id, tells rows apart even where a doc_id comes twice with different texts."""
    return F.xxhash64(F.col(text))


def same(left: str, right: str, keys: list[str]) -> Column:
    """Equality of the keys of two aliased frames; nulls are equal."""
    test = F.lit(True)
    for key in keys:
        test = test & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return test


__all__ = [
    "arrow_schema", "bound_batches", "id_type", "per_row", "same", "save_and_read",
    "squeeze", "text_key", "to_batch", "unsqueeze",
]
