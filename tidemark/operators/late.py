"""Events that arrive after their day was published."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.names import CATEGORY, PARTY, TIME
from tidemark.operators.snapshots import expand_days, validity

_EVENT = (PARTY, TIME, CATEGORY)


def late_changes(pictures: DataFrame, late: DataFrame, first: date, last: date) -> DataFrame:
    """The rows of the daily pictures `(day, party, time, category)` that late events change, as they must be.

    A day's picture is each party's latest event up to then. So a late event matters from its own day until
    something newer is known: it is compared, by `latest_first`, with what the days from then on show.
    Only parties with late events are joined, on days from `first` to `last` that have a picture at all.
    """
    days = pictures.select("day").distinct()
    may = expand_days(validity(late), first, last).join(days, "day", "left_semi")
    old = pictures.select("day", PARTY, F.col(TIME).alias("_time"), F.col(CATEGORY).alias("_category"), F.lit(True).alias("_known"))
    both = may.join(old, ["day", PARTY], "left")
    less = F.coalesce(F.col(CATEGORY) < F.col("_category"), F.col(CATEGORY).isNotNull() & F.col("_category").isNull())
    newer = F.col("_time").isNull() | (F.col(TIME) > F.col("_time")) | ((F.col(TIME) == F.col("_time")) & less)
    return both.where(F.col("_known").isNull() | newer).select("day", *_EVENT)


def with_changes(pictures: DataFrame, changes: DataFrame) -> DataFrame:
    """The pictures of the days that have changes, whole: unchanged rows and changed ones."""
    kept = pictures.join(changes.select("day").distinct(), "day", "left_semi")
    kept = kept.join(changes.select("day", PARTY), ["day", PARTY], "left_anti")
    return kept.select("day", *_EVENT).unionByName(changes.select("day", *_EVENT))
