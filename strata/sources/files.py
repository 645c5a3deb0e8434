"""Small files and folders on whatever file system a path belongs to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def system_of(spark: SparkSession, name: str):
    """(file system, path) of a name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def write_text(spark: SparkSession, name: str, text: str) -> int:
    """Write a small file; its time in milliseconds."""
    system, path = system_of(spark, name)
    out = system.create(path, True)
    out.write(bytearray(text.encode()))
    out.close()
    return system.getFileStatus(path).getModificationTime()


def read_text(spark: SparkSession, name: str) -> str:
    system, path = system_of(spark, name)
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, name: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all; never over another one."""
    system, path = system_of(spark, name)
    folder, last = name.rsplit("/", 1)
    hidden = f"{folder}/.{last}-{uuid.uuid4().hex}"
    write_text(spark, hidden, text)
    if system.exists(path) or not system.rename(system_of(spark, hidden)[1], path):
        raise FileExistsError(name)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, hidden names left out; nothing if it is not there."""
    system, path = system_of(spark, folder)
    if not system.exists(path):
        return []
    names = [s.getPath().getName() for s in system.listStatus(path)]
    return sorted(n for n in names if not n.startswith("."))


def remove(spark: SparkSession, name: str) -> None:
    system, path = system_of(spark, name)
    system.delete(path, True)
