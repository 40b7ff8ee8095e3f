"""Sessions from files of transactions as they arrive, with a limit to lateness."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.names import PARTY, TIME
from tidemark.operators import party_events
from tidemark.plans.job import TRANSACTIONS
from tidemark.plans.last_transaction import channel_rules
from tidemark.sources import transaction_stream

SESSIONS = "sessions"
_EARLY_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def run_sessions(
    spark: SparkSession, spec: Mapping[str, Any], *, gap_seconds: int = 1800, late_seconds: int = 86_400, files_per_batch: int | None = None
) -> None:
    """Writes the sessions that the files there are now bring to an end, below `outputs.sessions.path`; `read_sessions` reads them.

    Structured Streaming hands over the new files (`availableNow`). Open sessions stay in its state store, at most one row per
    party and session younger than the watermark. The watermark is the newest time of all batches before, less `late_seconds`; a
    session is written, once and for good, when its end, `gap_seconds` after its last event, is not behind the watermark.

    So a late event is defined: if its time and the gap reach beyond the watermark it joins, extends or bridges open sessions; else
    it is left out. `operators.sessions` over all files has such events as well. What is still open is written by a later run.
    The watermark begins at 1970. Times without a zone are put into the session's: set it to UTC.

    Events are not put together before the shuffle, though Spark could: it would do so before it looks for late ones, and a
    late event would be kept or not by the task that it is in. So all events of a party in a batch go to one task; for a
    party with a large share of them, `files_per_batch` bounds that. The checkpoint, below the same path, is the progress; a
    batch that broke off is written again under its number and counts once.
    """
    root = spec.get("outputs", {}).get(SESSIONS, {}).get("path")
    if not root:
        raise ValueError(f"outputs.{SESSIONS} needs a path")
    root = root.rstrip("/")
    events = party_events(transaction_stream(spark, spec, TRANSACTIONS, files_per_batch=files_per_batch), channel_rules(spec))
    kind = events.schema[TIME].dataType
    events = events.withColumn(TIME, F.col(TIME).cast("timestamp"))
    window = F.session_window(TIME, f"{int(gap_seconds)} seconds")
    found = events.withWatermark(TIME, f"{int(late_seconds)} seconds").groupBy(window, PARTY)
    first, last = (end(TIME).cast(kind).alias(name) for end, name in ((F.min, "first_event"), (F.max, "last_event")))
    found = found.agg(first, last, F.count(F.lit(1)).alias("events"))
    writer = found.select(PARTY, "first_event", "last_event", "events").writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", f"{root}/ended").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    before = spark.conf.get(_EARLY_MERGE)
    spark.conf.set(_EARLY_MERGE, "false")
    try:
        stream = writer.start()  # the query keeps the settings it starts with
    finally:
        spark.conf.set(_EARLY_MERGE, before)
    stream.awaitTermination()


def read_sessions(spark: SparkSession, spec: Mapping[str, Any]) -> DataFrame:
    """The sessions written so far: `msisdn, first_event, last_event, events`, each once."""
    root = spec["outputs"][SESSIONS]["path"].rstrip("/")
    try:
        return spark.read.parquet(f"{root}/ended")
    except AnalysisException as error:
        if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return spark.createDataFrame([], f"{PARTY} string, first_event timestamp, last_event timestamp, events long")
