"""Which folders of a table were reloaded, and when: tells replaced files from lost ones.

The record lies beside the table, in ``<table>.reloads``, and is there from the first
write. A reload leaves a mark in it before it begins and the folders it has replaced once
it is committed. What stood in such a folder at the time of the mark has been replaced;
times are those of the file system. A reload that failed leaves no record.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from strata.sources.files import system_of, write_text


def record(table: str) -> str:
    return f"{table.rstrip('/')}.reloads"


def keep_record(spark: SparkSession, table: str) -> None:
    system, path = system_of(spark, record(table))
    system.mkdirs(path)


def _files(spark: SparkSession, table: str) -> set[str]:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    try:
        return set(reader.option("recursiveFileLookup", "true").load(table).inputFiles())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return set()
        raise


@contextmanager
def recorded(spark: SparkSession, table: str, folders: Sequence[str] = ()) -> Iterator[None]:
    """Record the folders in which files come or go meanwhile, and ``folders``.

    Names are relative to the table; the empty one stands for the whole table.
    """
    keep_record(spark, table)
    before = _files(spark, table)
    name = f"{record(table)}/{uuid.uuid4()}"
    time = write_text(spark, f"{name}.mark", "")
    yield
    _, root = system_of(spark, table)
    top = root.toUri().getPath().rstrip("/")
    changed = {unquote(urlsplit(f).path).rsplit("/", 1)[0] for f in before ^ _files(spark, table)}
    inside = {f.split(f"{top}/", 1)[-1] if f != top else "" for f in changed}
    write_text(spark, f"{name}.json", json.dumps({"time": time, "folders": sorted({*inside, *folders})}))


def lost(spark: SparkSession, files: Sequence[tuple[str, int]]) -> list[str]:
    """Of files (name as a URI, time), those that have gone without a reload of their folder."""
    records: dict[str, list[dict] | None] = {}

    def reloads(table: str) -> list[dict] | None:
        if table not in records:
            system, path = system_of(spark, record(table))
            records[table] = None
            if system.exists(path):
                pages = [str(s.getPath()) for s in system.listStatus(path) if str(s.getPath()).endswith(".json")]
                records[table] = [json.loads(r.value) for r in spark.read.text(pages).collect()] if pages else []
        return records[table]

    gone = []
    for name, time in files:
        system, path = system_of(spark, unquote(name))
        if system.exists(path):
            continue
        table, inside, known = path.getParent(), "", None
        while table is not None and table.getName() and (known := reloads(table.toString())) is None:
            inside = f"{table.getName()}/{inside}".rstrip("/")
            table = table.getParent()
        if known is None:
            replaced = _overwritten(spark, name)
        else:
            replaced = any(time <= r["time"] and {"", inside} & {*r["folders"]} for r in known)
        if not replaced:
            gone.append(name)
    return gone


def _overwritten(spark: SparkSession, name: str) -> bool:
    """For folders nobody keeps a record of: whether another write alone fills the file's folder.

    Parts of one write share the middle of their names.
    """
    system, path = system_of(spark, unquote(name))
    folder, write = path.getParent(), path.getName().split(".")[0].split("-", 2)[-1].split("-c0")[0]
    there = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    parts = [n for n in there if n.endswith(".parquet")]
    return bool(parts) and not any(write in n for n in parts)
