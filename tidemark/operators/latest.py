"""Active-party filter and latest event per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.names import CATEGORY, PARTY, TIME


def latest_first() -> list[Column]:
    """Newest first; equal times go to the least category, so a rerun gives the same answer."""
    return [F.desc_nulls_last(TIME), F.asc_nulls_last(CATEGORY)]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order, whole.

    Spark plans `row_number() = 1` as a group limit on both sides of the shuffle, so a task sends at
    most one row per key: a key with a third of all rows costs its reducer one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def only_parties(
    events: DataFrame, parties: DataFrame, key: str = PARTY, *, broadcast: bool | None = None
) -> DataFrame:
    """Events whose party is listed. Duplicates in the list change nothing (left-semi join).

    `broadcast=True` sends the list to every executor, for lists known to be small; `False` never does;
    `None` leaves it to Spark and what it knows of the list's size.
    """
    listed = parties.select(key)
    if broadcast is not None:
        listed = F.broadcast(listed) if broadcast else listed.hint("merge")
    return events.join(listed, key, "left_semi")


def newest_per_category(events: DataFrame) -> DataFrame:
    """The newest time of every party and category: all that can still win under `latest_first`.

    A hash aggregate combined before the shuffle does this without sorting the events, and leaves the
    ranking a few rows per party.
    """
    return events.groupBy(PARTY, CATEGORY).agg(F.max(TIME).alias(TIME))


def latest_event(
    events: DataFrame, parties: DataFrame | None = None, *, broadcast: bool | None = None
) -> DataFrame:
    """The latest event of every party, or of the listed parties.

    With `broadcast=True`, for a list known to be small, events are filtered before they are shuffled.
    Otherwise they are cut to one row per party first and the filter runs on that same partitioning, with
    unique keys on the event side: right for a list of any size, also one that Spark cannot estimate
    (JDBC). `None` lets Spark choose that join, `False` rules a broadcast out.
    """
    if parties is not None and broadcast:
        events, parties = only_parties(events, parties, broadcast=True), None
    latest = latest_per_key(newest_per_category(events), [PARTY], latest_first()).select(PARTY, TIME, CATEGORY)
    return latest if parties is None else only_parties(latest, parties, broadcast=broadcast)
