"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}  # temporary folder of each session in one process


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below `spark.checkpoint.dir`, which every executor can reach.

    All paths of a session are in one folder, deleted when the session's application ends. Only a session
    that runs in one process may do without the setting and gets a temporary folder.
    """
    shared = spark.conf.get(_SETTING, None) or _LOCAL.get(spark.sparkContext.applicationId)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        shared = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="run-")
    session = f"{shared.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"
    system, folder = _hadoop(spark, session)
    if not system.exists(folder):
        system.mkdirs(folder)
        system.deleteOnExit(folder)
    return f"{session}/{name}-{uuid4().hex}"


@contextmanager
def materialised(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`df` written to the shared folder and read from there, removed at the end of the block.

    For a result several writes depend on: computed once, safe against lost executors, and its size
    is known to the planner.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path of any Hadoop file system."""
    system, place = _hadoop(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes what is at a path of any Hadoop file system, if there is something."""
    system, place = _hadoop(spark, path)
    system.delete(place, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a Hadoop glob matches."""
    system, place = _hadoop(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(place) or []]


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place
