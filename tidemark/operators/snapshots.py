"""Last known event per party, as of each day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import on_days
from tidemark.names import CATEGORY, PARTY, TIME
from tidemark.operators.calendar import each_day
from tidemark.operators.events import union_events
from tidemark.operators.latest import latest_event, latest_first, latest_per_key

_EVENT = (PARTY, TIME, CATEGORY)


def advance_state(state: DataFrame, events: DataFrame, first: date, last: date | None = None) -> DataFrame:
    """State at the end of `last`: the earlier state and the events of `first` to `last`, latest per party.

    The state holds every party. Filter by status when publishing: a party that becomes active again
    still has its history.
    """
    new = events.where(on_days(TIME, first, last or first))
    return latest_event(union_events(state.select(*_EVENT), new.select(*_EVENT)))


def newest_per_category_and_day(events: DataFrame) -> DataFrame:
    """The newest time of every party, day and category: all that daily pictures are made of."""
    dated = events.select(*_EVENT, F.to_date(TIME).alias("_day")).where("_day is not null")
    return dated.groupBy(PARTY, "_day", CATEGORY).agg(F.max(TIME).alias(TIME)).select(*_EVENT)


def validity(events: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The days on which an event is its party's last known one: `valid_from`, `valid_to`.

    `valid_to` is null while nothing newer is known. `state` is what was known before the first of
    the events. Events are cut before anything is sorted, to the newest of each party, day and category
    by a hash aggregate; one row per party and day remains of that, whose number the calendar bounds.
    """
    day = F.to_date(TIME)
    newest = newest_per_category_and_day(events).withColumn("valid_from", day)
    known = latest_per_key(newest, [PARTY, "valid_from"], latest_first()).select(*_EVENT, "valid_from")
    if state is not None:
        known = known.unionByName(state.select(*_EVENT, day.alias("valid_from")))
    next_day = F.lead("valid_from").over(Window.partitionBy(PARTY).orderBy("valid_from"))
    return known.withColumn("valid_to", F.date_sub(next_day, 1))


def expand_days(valid: DataFrame, first: date, last: date) -> DataFrame:
    """A validity table as one snapshot per day from `first` to `last`."""
    start = F.greatest("valid_from", F.lit(first))
    end = F.least("valid_to", F.lit(last))  # skips nulls
    return each_day(valid, start, end).select("day", *_EVENT)


def daily_snapshots(events: DataFrame, first: date, last: date, state: DataFrame | None = None) -> DataFrame:
    """For every day, each known party's latest event up to the end of that day.

    One job for the whole range, however many days; equal to folding `advance_state` day by day.
    """
    until = events.where(F.col(TIME) < F.date_add(F.lit(last), 1))
    return expand_days(validity(until, state), first, last)
