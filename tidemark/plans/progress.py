"""Which day each job has reached: an append-only table, Parquet or JDBC.

A write adds a row and never rewrites others, so jobs can share the table. A job's progress is its
greatest day: reprocessing an old day does not move it back.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.names import DONE, JOB, PROGRESS_SCHEMA, UPDATED
from tidemark.operators import latest_per_key
from tidemark.sinks import write_output
from tidemark.sources import read_source


def create_progress(spark: SparkSession, spec: Mapping[str, Any]) -> None:
    """Creates the table where it is missing."""
    empty = spark.createDataFrame([], PROGRESS_SCHEMA)
    write_output(empty, _store(spec), "progress", mode="ignore", skip_empty=False)


def append_progress(rows: DataFrame, spec: Mapping[str, Any]) -> None:
    """Adds (job, day) rows, stamped with the current time."""
    stamped = rows.select(
        F.col(JOB).cast("string"), F.col(DONE).cast("date"), F.current_timestamp().alias(UPDATED)
    )
    write_output(stamped, _store(spec), "progress", mode="append", skip_empty=False)


def mark_done(spark: SparkSession, spec: Mapping[str, Any], day: date) -> None:
    """Adds the row that says the job of this spec has processed `day`."""
    if not isinstance(day, date) or isinstance(day, datetime):
        raise ValueError(f"day must be a date, not {day!r}")
    append_progress(spark.createDataFrame([(job_name(spec), day)], f"{JOB} string, {DONE} date"), spec)


def read_progress(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    """One row per job: its greatest day, and when that was written. A table that cannot be read is an error."""
    rows = read_source(spark, _store(spec), "progress", **_schema(spec))
    return latest_per_key(rows, [JOB], [F.desc_nulls_last(DONE), F.desc_nulls_last(UPDATED)])


def last_done(spark: SparkSession, spec: Mapping[str, Any]) -> date | None:
    """The day the job of this spec has reached, None before its first run."""
    mine = F.col(JOB) == job_name(spec)
    rows = read_source(spark, _store(spec), "progress", **_schema(spec))
    return rows.where(mine).agg(F.max(DONE)).first()[0]


def job_name(spec: Mapping[str, Any]) -> str:
    name = spec.get("metadata", {}).get("job_name_identifier")
    if not name:
        raise ValueError("metadata.job_name_identifier is required")
    return name


def _store(spec: Mapping[str, Any]) -> dict[str, Any]:
    """The table of `spec["metadata"]` as a source and an output."""
    place = spec.get("metadata", {})
    if path := place.get("tracker_path"):
        entry = {"path": path}
    elif place.get("tracker_db_table") and place.get("metadata_db_connection_name"):
        entry = {
            "connection_name": place["metadata_db_connection_name"],
            "db_type": "jdbc",
            "table": place["tracker_db_table"],
            "options_override": place.get("options_override"),
        }
    else:
        raise ValueError("metadata needs tracker_path, or metadata_db_connection_name and tracker_db_table")
    return {
        "connections": spec.get("connections", {}),
        "data_sources": {"progress": entry},
        "outputs": {"progress": entry},
    }


def _schema(spec: Mapping[str, Any]) -> dict[str, str]:
    return {"schema": PROGRESS_SCHEMA} if spec["metadata"].get("tracker_path") else {}
