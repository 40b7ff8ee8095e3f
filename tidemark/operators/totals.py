"""Totals over groups of columns and over moving days, from one small aggregate of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Measure -> (over the rows, over what those gave)
_MEASURES = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def _measures(measures: Mapping[str, tuple[str, str]], step: int) -> dict[str, Column]:
    """The aggregates of a step: 0 over the rows, 1 over totals that are named as the measures are."""
    for kind, _ in measures.values():
        if kind not in _MEASURES:
            raise ValueError(f"measure {kind!r} is not one of {', '.join(_MEASURES)}")
    return {
        name: _MEASURES[kind][step](F.lit(1) if column == "*" and not step else F.col(name if step else column))
        for name, (kind, column) in measures.items()
    }


def _named(columns: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def totals_by(
    df: DataFrame, sets: Sequence[Sequence[str]], measures: Mapping[str, tuple[str, str]], *, grouping_id: str = "grouping_id"
) -> DataFrame:
    """Totals for each of several sets of columns: SQL's `GROUPING SETS`.

    `measures` maps an output column to a measure (count, sum, min, max) and a column, `*` for rows. Columns
    come in the order in which the sets first name them, null where a row's set has not got them; `grouping_id`
    tells that from a null in the data, one bit per column, the first column's the highest. An empty set is the
    total over all, which has no row if there are no rows.

    Expanding every row once per set would multiply the shuffle by their number. Here the rows are read once and
    combined to one row per combination of all columns, and only these are expanded.
    """
    columns = list(dict.fromkeys(column for each in sets for column in each))
    if not columns:
        raise ValueError("no columns to group by")
    finest = df.groupBy(*columns).agg(*_named(_measures(measures, 0)))
    wanted = [[F.col(column) for column in each] for each in sets]
    return finest.groupingSets(wanted, *columns).agg(F.grouping_id().alias(grouping_id), *_named(_measures(measures, 1)))


def moving_totals(
    df: DataFrame, key: str, time: str, measures: Mapping[str, tuple[str, str]], *, days: int = 7, day: str = "day"
) -> DataFrame:
    """For each key and day that has rows, the totals of that day and the `days - 1` before: `key, day, *measures`.

    Measures are as in `totals_by`. Days are calendar days, so a day without rows counts as one. Rows without a
    key or a time are left out.

    No window sees a row of `df`: rows are combined to one per key and day before the shuffle, and the frame, a range of days,
    slides over these. A key has at most as many as the calendar has days, however many rows it has.
    """
    if days < 1:
        raise ValueError("a window has at least one day")
    daily = df.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(key, F.to_date(time).alias(day))
    frame = Window.partitionBy(key).orderBy(F.unix_date(day)).rangeBetween(1 - days, 0)
    moving = {name: column.over(frame) for name, column in _measures(measures, 1).items()}
    return daily.agg(*_named(_measures(measures, 0))).select(key, day, *_named(moving))
