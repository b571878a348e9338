"""Session for local runs, and the shared scratch area of a session."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", name: str = "telhado", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@cache
def _test_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="telhado-")


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the session names in spark.checkpoint.dir.

    Only a local session that names none gets a temporary folder: on a cluster each executor would
    write to a disk of its own, so there the setting must be given.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not is_local(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (root or _test_dir(spark.sparkContext.applicationId)).rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, with the file system that Spark takes it on.

    Tasks that write files themselves must not take a path without a scheme for a disk of their own.
    """
    root = shared_dir(spark)
    if ":" not in root.split("/")[0]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        full = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
        root = root if full.startswith("file:") else full
    return f"{root}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this application wrote."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_scratch = threading.local()


def _written() -> list[str]:
    """Tables this thread has materialised: jobs in other threads keep their own."""
    if not hasattr(_scratch, "paths"):
        _scratch.paths = []
    return _scratch.paths


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts lineage in a way that outlives lost executors, and gives the planner the
    true size of the table, on which its broadcast decision rests.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    _written().append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside are deleted at the end, when the job's own output is written."""
    written = _written()
    before = len(written)
    try:
        yield
    finally:
        for path in written[before:]:
            remove(spark, path)
        del written[before:]
