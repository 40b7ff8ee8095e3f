"""Late transactions put into what is already published, without running the days again."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.names import CATEGORY, OUT_CATEGORY, OUT_DAY, OUT_PARTY, OUT_TIME, PARTY, TIME
from tidemark.operators import late_changes, only_parties, party_events, with_changes
from tidemark.plans.job import OUTPUT, STATE, USERS
from tidemark.plans.last_transaction import channel_rules, shape_output
from tidemark.sinks import replaces_partitions, write_output
from tidemark.sources import active_parties, read_source
from tidemark.storage import exists, materialised


def repair_job(
    spark: SparkSession, spec: Mapping[str, Any], late: DataFrame, *, broadcast: bool | None = None
) -> dict[str, list[date]]:
    """Puts late transactions (logical columns) into published days and kept states; the days replaced, per table.

    The result is that of a full rebuild with these rows, as long as the list of active parties is that of the
    runs before; a party that became active since comes in by `initial`. Only days whose picture changes
    are written, one after the other table; a repair that broke off can be repeated, as the latest
    event of each party stays the same. Days that are not published yet are left to their run.
    """
    for name in (OUTPUT, STATE):
        entry = spec["outputs"].get(name, {})
        if name == OUTPUT and (not replaces_partitions(entry) or entry.get("partition_by") not in (OUT_DAY, [OUT_DAY])):
            raise ValueError(f"output {name!r} must be partitioned by {OUT_DAY} to be repaired")
    events = party_events(late, channel_rules(spec))
    replaced: dict[str, list[date]] = {OUTPUT: [], STATE: []}
    with materialised(events, "late") as events:
        first = events.agg(F.min(F.to_date(TIME))).first()[0]
        if first is None:
            return replaced
        active = active_parties(spark, spec, USERS)
        shown = _stored(spark, spec, OUTPUT, {OUT_PARTY: PARTY, OUT_TIME: TIME, OUT_CATEGORY: CATEGORY})
        replaced[OUTPUT] = _repair(spark, spec, OUTPUT, shown, only_parties(events, active, broadcast=broadcast), first)
        if exists(spark, spec["outputs"][STATE]["path"]):
            replaced[STATE] = _repair(spark, spec, STATE, _stored(spark, spec, STATE, {}), events, first)
    return replaced


def _stored(spark: SparkSession, spec: Mapping[str, Any], name: str, names: dict[str, str]) -> DataFrame:
    entry = spec["outputs"][name]
    place = {key: entry[key] for key in ("path", "format", "output_type") if key in entry}
    rows = read_source(spark, {"data_sources": {name: place}}, name).withColumnsRenamed(names)
    return rows.select(F.col(OUT_DAY).cast("date").alias("day"), PARTY, TIME, CATEGORY)


def _repair(
    spark: SparkSession, spec: Mapping[str, Any], name: str, pictures: DataFrame, events: DataFrame, first: date
) -> list[date]:
    last = pictures.agg(F.max("day")).first()[0]
    if last is None or last < first:
        return []
    recent = pictures.where(F.col("day") >= F.lit(first))
    with materialised(late_changes(recent, events, first, last), "changes") as changes:
        days = sorted(row["day"] for row in changes.select("day").distinct().collect())  # bounded by the calendar
        if not days:
            return []
        # Read in full before the same partitions are replaced.
        with materialised(with_changes(pictures.where(F.col("day").isin(days)), changes), "repaired") as whole:
            if name == OUTPUT:
                whole = whole.withColumnsRenamed({TIME: OUT_TIME, CATEGORY: OUT_CATEGORY})
                write_output(shape_output(whole, spec, F.col("day")), spec, name)
            else:
                place = {**spec["outputs"][name], "partition_by": [OUT_DAY], "mode": "overwrite"}
                write_output(whole.withColumnRenamed("day", OUT_DAY), {"outputs": {name: place}}, name)
    return days
