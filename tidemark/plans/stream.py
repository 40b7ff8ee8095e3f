"""The job as a stream: files of transactions are published as they arrive, whatever days they hold."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import on_days
from tidemark.names import OUT_DAY, TIME
from tidemark.operators import StageCounts, newest_per_category_and_day, party_events, whole_plans
from tidemark.plans.job import OUTPUT, STATE, TRANSACTIONS, publish_days
from tidemark.plans.last_transaction import channel_rules
from tidemark.sinks import replaces_partitions
from tidemark.sources import read_source, transaction_stream
from tidemark.storage import exists

INCREMENTS = "increments"


def run_stream(
    spark: SparkSession,
    spec: Mapping[str, Any],
    as_of: date,
    *,
    files_per_batch: int | None = None,
    broadcast: bool | None = None,
) -> date | None:
    """Publishes all days before `as_of` from the transaction files there are now, reading each file once over all runs;
    the last day published.

    Structured Streaming hands over the files that are new since the last run (`availableNow`), in batches. A batch is cut
    to what daily pictures need, one row per party, day and category, and kept as its own partition below
    `outputs.increments.path`; then its days and all later published ones are published again from the newest
    state before them. So files may hold days of any age, in any order: the result is that of `run_job` over all files.
    In the end days without new files are published up to the eve of `as_of`.

    The checkpoint, below the same path, is the progress: it moves on after a batch is published. A batch that
    broke off comes again with its number and the same files, replaces its partition and publishes the same days.
    """
    entry = spec.get("outputs", {}).get(OUTPUT, {})
    if not replaces_partitions(entry) or entry.get("partition_by") not in (OUT_DAY, [OUT_DAY]):
        raise ValueError(f"output {OUTPUT!r} must be partitioned by {OUT_DAY} to be streamed into")
    for name in (STATE, INCREMENTS):
        if not spec["outputs"].get(name, {}).get("path"):
            raise ValueError(f"outputs.{name} needs a path")
    root, yesterday = spec["outputs"][INCREMENTS]["path"].rstrip("/"), as_of - timedelta(days=1)
    arriving = transaction_stream(spark, spec, TRANSACTIONS, files_per_batch=files_per_batch)
    stream = arriving.writeStream.foreachBatch(lambda rows, number: fold_batch(spark, spec, rows, number, yesterday, broadcast))
    stream = stream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    stream.awaitTermination()
    if not exists(spark, f"{root}/events"):
        return None
    reached = _published_to(spark, spec)
    if reached is not None and reached < yesterday:
        _publish(spark, spec, reached + timedelta(days=1), yesterday, broadcast)
    return _published_to(spark, spec)


def fold_batch(
    spark: SparkSession, spec: Mapping[str, Any], rows: DataFrame, number: int, yesterday: date, broadcast: bool | None = None
) -> None:
    """Keeps one batch of transactions and publishes the days it changes. Done twice, it gives the same."""
    kept = f"{spec['outputs'][INCREMENTS]['path'].rstrip('/')}/events/batch={number}"
    newest_per_category_and_day(party_events(rows, channel_rules(spec))).write.mode("overwrite").parquet(kept)
    first, last = spark.read.parquet(kept).agg(F.min(F.to_date(TIME)), F.max(F.to_date(TIME))).first()
    if first is None:
        return
    reached = _published_to(spark, spec)
    last = min(last, yesterday)
    if reached is not None:
        first, last = min(first, reached + timedelta(days=1)), max(last, reached)
    if first <= last:
        _publish(spark, spec, first, last, broadcast)


def _publish(spark: SparkSession, spec: Mapping[str, Any], first: date, last: date, broadcast: bool | None) -> None:
    root = spec["outputs"][INCREMENTS]["path"].rstrip("/")

    def events_of(since: date | None, until: date, _: StageCounts) -> DataFrame:
        return spark.read.parquet(f"{root}/events").drop("batch").where(on_days(TIME, since, until))

    with whole_plans(spark):
        publish_days(spark, spec, first, last, events_of, broadcast)


def _published_to(spark: SparkSession, spec: Mapping[str, Any]) -> date | None:
    """The last published day: its state is kept."""
    place = {"path": spec["outputs"][STATE]["path"]}
    if not exists(spark, place["path"]):
        return None
    states = read_source(spark, {"data_sources": {STATE: place}}, STATE, schema=f"{OUT_DAY} date")
    return states.agg(F.max(OUT_DAY)).first()[0]
