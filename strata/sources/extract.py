"""Text exports: hierarchical tagged files and tables as SQL statements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.ordered import BLOCK_BITS, nearest

# fixed values: line tags of the file, in the order they appear
HEADER, CLIENT, PARENT, CHILD, COVER, FOOTER, COUNTS = "HDR", "CLI", "CTR", "SBP", "COM", "FTR", "CNT"
SEPARATOR = "|"


def _line(tag: str, columns: Sequence[str]) -> Column:
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.concat_ws(SEPARATOR, F.lit(tag), *values)


def tagged_lines(
    parents: DataFrame,
    children: DataFrame,
    covers: DataFrame,
    parent_key: str,
    child_order: str,
    client: Sequence[str],
    header: Sequence[str],
    columns: dict[str, Sequence[str]],
) -> DataFrame:
    """All lines of the file with their place: (section, parent, level, position, line).

    The trailer counts client, parent, child and cover lines and their total; it is one
    aggregate over the body.
    """
    spark = parents.sparkSession

    def body(df: DataFrame, tag: str, level: int, order: Column) -> DataFrame:
        return df.select(
            F.lit(2).alias("section"),
            F.col(parent_key).cast("string").alias("parent"),
            F.lit(level).alias("level"),
            order.cast("long").alias("position"),
            F.lit(tag).alias("tag"),
            _line(tag, columns[tag]).alias("line"),
        )

    lines = body(parents, PARENT, 0, F.lit(0))
    lines = lines.unionByName(body(children, CHILD, 1, F.col(child_order)))
    lines = lines.unionByName(body(covers, COVER, 2, F.lit(0)))

    frame = [
        (0, "", 0, 0, HEADER, SEPARATOR.join([HEADER, *header])),
        (1, "", 0, 0, CLIENT, SEPARATOR.join([CLIENT, *client])),
        (3, "", 0, 0, FOOTER, SEPARATOR.join([FOOTER, *header])),
    ]
    schema = "section int, parent string, level int, position long, tag string, line string"
    ends = spark.createDataFrame(frame, schema)
    number = [F.count_if(F.col("tag") == t) for t in (PARENT, CHILD, COVER)]
    totals = lines.agg(*[n.alias(f"n{i}") for i, n in enumerate(number)]).select(
        F.concat_ws(
            SEPARATOR,
            F.lit(COUNTS),
            F.lit(1),
            "n0",
            "n1",
            "n2",
            F.lit(1) + F.col("n0") + F.col("n1") + F.col("n2"),
        ).alias("line")
    )
    trailer = totals.select(
        F.lit(4).alias("section"),
        F.lit("").alias("parent"),
        F.lit(0).alias("level"),
        F.lit(0).cast("long").alias("position"),
        F.lit(COUNTS).alias("tag"),
        "line",
    )
    return lines.unionByName(ends).unionByName(trailer)


def write_lines(lines: DataFrame, path: str) -> None:
    """Write in file order: part files, read by name, are the file."""
    place = ["section", "parent", "level", "position"]
    lines.orderBy(*place).select("line").write.text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with tag, fields and the parent line they stand under.

    A line belongs to the last parent line above it. The position is (number of the part
    file, file, split, line), so the search runs per split and crosses splits on one row
    each, and blocks of part files on one row each.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )
    # by number: as text, part 100000 would come before part 99999
    number = F.regexp_extract("file", r"part-(\d{1,18})[^/]*$", 1)
    raw = raw.withColumn("part", F.when(number != "", number.cast("long")))
    raw = raw.withColumn("parts", F.shiftright("part", 10))
    fields = F.split("line", r"\|")
    lines = raw.filter(F.trim("line") != "").withColumns(
        {"tag": fields[0], "fields": F.slice(fields, F.lit(2), F.size(fields) - 1), "block": F.shiftright("at", BLOCK_BITS)}
    )
    own = F.when(F.col("tag") == PARENT, F.col("fields")[0])
    placed = nearest(lines, [], ["parts", "part", "file", "split", "block", "at"], own, "under", inclusive=True)
    inside = F.col("tag").isin(PARENT, CHILD, COVER)
    return placed.select("tag", "fields", F.when(inside, F.col("under")).alias("parent"))


def reconcile(lines: DataFrame) -> DataFrame:
    """Counted against stated lines per tag, from the trailer of a read file."""
    names = (CLIENT, PARENT, CHILD, COVER)
    counted = [F.count_if(F.col("tag") == t).alias(f"c{i}") for i, t in enumerate(names)]
    stated = F.max(F.when(F.col("tag") == COUNTS, F.col("fields"))).alias("trailer")
    totals = lines.agg(*counted, stated)
    all_lines = F.col("c0") + F.col("c1") + F.col("c2") + F.col("c3")
    pairs = [(t, F.col(f"c{i}"), i) for i, t in enumerate(names)] + [("TOTAL", all_lines, 4)]
    rows = [
        F.struct(
            F.lit(t).alias("tag"),
            n.alias("counted"),
            F.col("trailer")[i].cast("long").alias("stated"),
        )
        for t, n, i in pairs
    ]
    return totals.select(F.inline(F.array(*rows))).withColumn(
        "matches", F.col("counted").eqNullSafe(F.col("stated"))
    )


def create_statement(name: str, schema: T.StructType) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns});"


def value_rows(
    df: DataFrame, limit: int | None = None, order: Sequence[str] = (), escape_backslashes: bool = False
) -> DataFrame:
    """One SQL value list per row; read back, it gives the same values.

    Dates, timestamps and binary values are typed literals. Backslashes are doubled only
    with ``escape_backslashes``, for readers that take them as escapes (Spark does, ANSI
    does not). A column whose type has no literal is refused.
    """

    def quoted(text: Column) -> Column:
        text = F.replace(text, F.lit("'"), F.lit("''"))
        if escape_backslashes:
            text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        return F.concat(F.lit("'"), text, F.lit("'"))

    def literal(field: T.StructField) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.StringType):
            text = quoted(column)
        elif isinstance(kind, T.BooleanType):
            text = F.when(column, "TRUE").otherwise("FALSE")
        elif isinstance(kind, T.DateType):
            text = F.concat(F.lit("DATE "), quoted(column.cast("string")))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            shown = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
            text = F.concat(F.lit("TIMESTAMP "), quoted(shown))
        elif isinstance(kind, T.BinaryType):
            text = F.concat(F.lit("X'"), F.hex(column), F.lit("'"))
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            # NaN and infinities are no numerals
            name = "DOUBLE" if isinstance(kind, T.DoubleType) else "FLOAT"
            plain = column.cast("string")
            odd = F.isnan(column) | (F.abs(column) == float("inf"))
            text = F.when(odd, F.concat(F.lit("CAST("), quoted(plain), F.lit(f" AS {name})"))).otherwise(plain)
        elif isinstance(kind, T.NumericType):
            text = column.cast("string")
        else:
            raise TypeError(f"{field.name}: {kind.simpleString()} has no SQL literal")
        return F.when(column.isNull(), "NULL").otherwise(text)

    chosen = df.orderBy(*order) if order else df
    chosen = chosen if limit is None else chosen.limit(limit)
    values = F.concat_ws(", ", *[literal(f) for f in df.schema.fields])
    return chosen.select(F.concat(F.lit("("), values, F.lit(")")).alias("value_row"))


def insert_statements(
    df: DataFrame, name: str, limit: int | None = None, order: Sequence[str] = (), escape_backslashes: bool = False
) -> DataFrame:
    """One INSERT per row, so that a large table is written by many tasks."""
    columns = ", ".join(f"`{c}`" for c in df.columns)
    head = F.lit(f"INSERT INTO {name} ({columns}) VALUES ")
    return value_rows(df, limit, order, escape_backslashes).select(F.concat(head, "value_row", F.lit(";")).alias("value"))
