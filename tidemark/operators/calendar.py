"""Which days a run has to process."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("initial", "daily", "catchup", "specific_date")


def each_day(df: DataFrame, first: Column, last: Column, name: str = "day") -> DataFrame:
    """Every row once per day from `first` to `last`, both included.

    Rows with a missing bound or `first > last` give no day; `sequence` alone would count backwards.
    """
    days = F.sequence(F.col("_first"), F.col("_last"), F.expr("interval 1 day"))
    return (
        df.withColumns({"_first": first.cast("date"), "_last": last.cast("date")})
        .where("_first <= _last")
        .withColumn(name, F.explode(days))
        .drop("_first", "_last")
    )


def catchup_days(progress: DataFrame, done: Column, yesterday: Column, name: str = "day") -> DataFrame:
    """The days each job still owes, one row per job and day.

    From the day after `done` to `yesterday`; a job with no progress owes yesterday only, an
    up-to-date job nothing.
    """
    return each_day(progress, F.coalesce(F.date_add(done, 1), yesterday.cast("date")), yesterday, name)


def processing_range(
    mode: str,
    as_of: date,
    done: date | None = None,
    *,
    start: date | str | None = None,
    end: date | str | None = None,
    day: date | str | None = None,
) -> tuple[date, date] | None:
    """First and last day of a run on `as_of`, or None when there is nothing to do."""
    yesterday = as_of - timedelta(days=1)
    if mode in ("daily", "catchup"):
        first, last = (done + timedelta(days=1) if done else yesterday), yesterday
    elif mode == "specific_date":
        first = last = _day(day, "day")
        if first > yesterday:
            return None
    elif mode == "initial":
        first, last = _day(start, "start"), _day(end, "end")
        if first > last:
            raise ValueError(f"start {first} is after end {last}")
        last = min(last, yesterday)
    else:
        raise ValueError(f"unknown mode {mode!r}; one of {', '.join(MODES)}")
    return (first, last) if first <= last else None


def processing_days(spark: SparkSession, mode: str, as_of: date, done: date | None = None, **bounds) -> DataFrame:
    """`processing_range` as a DataFrame of ascending days."""
    first, last = processing_range(mode, as_of, done, **bounds) or (None, None)
    one_row = spark.range(1).select()
    return each_day(one_row, F.lit(first), F.lit(last))


def _day(value: date | str | None, name: str) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    if not value:
        raise ValueError(f"{name} is required (YYYY-MM-DD)")
    try:
        return datetime.strptime(value, "%Y-%m-%d").date()
    except ValueError as error:
        raise ValueError(f"{name} is not a YYYY-MM-DD day: {value!r}") from error
