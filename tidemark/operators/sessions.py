"""Sessions: runs of a party's events without a long pause."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import clock_seconds


def sessions(events: DataFrame, key: str, time: str, *, gap_seconds: int = 1800, slot_seconds: int = 86_400) -> DataFrame:
    """`key, first_event, last_event, events` of each session: an event that comes at most `gap_seconds` after the one before
    belongs to its session. Rows without a key or a time are left out.

    A window over a key would sort all its events in one task. Here events of one time are counted before the shuffle,
    a key is cut into slots of time, each slot into pieces without a pause, and pieces that touch across
    slots are put together. A task sorts one slot of a key, then its pieces, of which a slot has at most
    `slot_seconds / gap_seconds`, rounded up, and one.
    """
    if gap_seconds < 1 or slot_seconds < 1:
        raise ValueError("gap and slot take at least a second")
    known = events.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    slot = F.floor(clock_seconds(known, time) / slot_seconds).alias("_slot")
    times = known.groupBy(key, slot, F.col(time).alias("first_event")).agg(F.count(F.lit(1)).alias("events"))
    pieces = _joined(times.withColumn("last_event", F.col("first_event")), [key, "_slot"], gap_seconds)
    return _joined(pieces, [key], gap_seconds).select(key, "first_event", "last_event", "events")


def _joined(spans: DataFrame, keys: list[str], gap_seconds: int) -> DataFrame:
    """Spans that do not overlap, put together where the pause between two is no longer than the gap."""
    order = Window.partitionBy(*keys).orderBy("first_event")
    before = F.lag("last_event").over(order) + F.expr(f"interval {int(gap_seconds)} seconds")
    starts = F.when(F.col("first_event") <= before, 0).otherwise(1)
    numbered = spans.withColumn("_starts", starts).withColumn("_run", F.sum("_starts").over(order))
    return numbered.groupBy(*keys, "_run").agg(
        F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"), F.sum("events").alias("events")
    )
