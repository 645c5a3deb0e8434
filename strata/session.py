"""Session defaults and the shared work folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "strata", **conf: str) -> SparkSession:
    """A session with the settings the library is written for.

    Partition counts are left to the adaptive planner: it starts from
    ``spark.sql.shuffle.partitions`` and merges or splits by measured size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of its
    own; on a cluster a machine-local folder would be lost with the executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="strata-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one; nothing is ever reused or cleared."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def save_and_read(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a written table that survives executor loss."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
