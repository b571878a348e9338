"""Dated full-table snapshots: `<root>/snapshot_date=YYYYMMDD/run=NNN/*.parquet`.

A rerun on one day writes the next run of that day and supersedes the earlier one,
so a job may read the day's snapshot and replace it. Only runs marked complete are ever
read, so a write cut short leaves the previous snapshot in force.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..schemas import ensure_columns
from ..session import remove

LAYERS = ("bronze", "silver", "gold")
TRACKS = ("municipal", "hexagonal")
MARKER = "_SUCCESS"


class SnapshotMissing(Exception):
    """No complete snapshot lies under the given root."""


def snapshot_root(base: str, layer: str, track: str) -> str:
    if layer not in LAYERS or track not in TRACKS:
        raise ValueError(f"unknown layer or track: {layer}/{track}")
    return f"{base.rstrip('/')}/{layer}/{track}"


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, through Hadoop's file system, so any scheme Spark reads will do."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def _runs(spark: SparkSession, root: str, stamp: str) -> list[int]:
    found = [re.fullmatch(r"run=(\d+)", n) for n in _children(spark, f"{root}/snapshot_date={stamp}")]
    return sorted((int(m[1]) for m in found if m), reverse=True)


def snapshot_stamps(spark: SparkSession, root: str) -> list[str]:
    """Days with a folder under `root`, newest first."""
    found = [re.fullmatch(r"snapshot_date=(\d{8})", n) for n in _children(spark, root)]
    return sorted((m[1] for m in found if m), reverse=True)


def latest_path(spark: SparkSession, root: str) -> str | None:
    for stamp in snapshot_stamps(spark, root):
        for run in _runs(spark, root, stamp):
            path = f"{root}/snapshot_date={stamp}/run={run:03d}"
            if MARKER in _children(spark, path):
                return path
    return None


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One named Parquet file or folder; the scheme stays in the address."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_latest(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Newest complete snapshot; only its own files are listed and read."""
    path = latest_path(spark, root)
    if path is None:
        raise SnapshotMissing(f"no snapshot under {root}")
    return read_parquet(spark, path, schema)


def read_latest_or_empty(
    spark: SparkSession, root: str, schema: T.StructType, needs: tuple[str, ...] = ("url",)
) -> DataFrame:
    """Newest snapshot with every column of `schema`, those it lacks as NULLs.

    An empty table when there is none, or when it lacks a column of `needs`, without which its rows say nothing.
    """
    path = latest_path(spark, root)
    if path is not None:
        found = read_parquet(spark, path)
        if set(needs) <= set(found.columns):
            return ensure_columns(found, schema)
    return spark.createDataFrame([], schema)


def write_snapshot(
    df: DataFrame, root: str, stamp: str, keep: Callable[[], bool] | None = None
) -> str | None:
    """Write `df` whole as the newest run of day `stamp`; returns the folder.

    `keep` is asked once the rows are written, and so may look at what was observed while
    writing. When it says no, the run is removed unmarked and the result is None.
    """
    if not re.fullmatch(r"\d{8}", stamp):
        raise ValueError(f"not a day stamp: {stamp}")
    spark = df.sparkSession
    runs = _runs(spark, root, stamp)
    path = f"{root}/snapshot_date={stamp}/run={(runs[0] + 1 if runs else 1):03d}"
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    if keep is not None and not keep():
        remove(spark, path)
        return None
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MARKER}")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker).close()
    return path


def write_counted(df: DataFrame, root: str, stamp: str, **counts: Column) -> tuple[str, dict[str, int]]:
    """`write_snapshot`, and the given aggregates of the rows as they were written.

    The counts are observed by the tasks that write, so the rows are neither read nor worked out again. A
    task that is run again counts once, since nothing is shuffled behind the place they are taken.
    """
    seen = Observation()
    path = write_snapshot(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), root, stamp)
    return path, dict(seen.get)


def newest_rows(df: DataFrame, stamp: Column) -> DataFrame:
    """Rows of the newest stamp, for a table that holds many snapshots.

    The newest stamp is one scalar, so it comes back as a literal: the scan then
    prunes partitions and row groups on it.
    """
    newest = df.agg(F.max(stamp).alias("m")).head()["m"]
    return df.filter(stamp == F.lit(newest))
