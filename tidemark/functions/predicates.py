from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_text(column: Column | str, value: str) -> Column:
    """Case-insensitive equality; null never matches."""
    return F.upper(column) == F.upper(F.lit(value))


def on_days(column: Column | str, first: date | None, last: date) -> Column:
    """Both days included, up to the last microsecond. Without a first day, everything up to the last.

    Half-open on purpose: the column stays bare, so the comparison reaches a Parquet or JDBC scan.
    """
    column = F.col(column) if isinstance(column, str) else column
    until = column < F.lit(last + timedelta(days=1))
    return until if first is None else (column >= F.lit(first)) & until


def has_party(column: Column | str) -> Column:
    """Neither null nor empty. Blanks are kept: `" "` is an id like any other."""
    column = F.col(column) if isinstance(column, str) else column
    return column.isNotNull() & (column.cast("string") != "")
