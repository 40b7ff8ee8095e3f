"""Interval join: rows with a time against spans of time of the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import clock_seconds

_WIDER = 8  # a level's slots are so many times as long as those of the level below


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    key: str,
    time: str,
    start: str,
    end: str,
    values: Sequence[str],
    *,
    slot_seconds: int = 86_400,
    pieces: int = 16,
) -> DataFrame:
    """Each row of `points` with the `values` of every span of its key that holds its time: `start` <= time < `end`.

    An `end` that is null is open. Points without a key or a time, spans without a key or a start, and spans that end
    where they start or before match nothing. Equal spans each give a row. `points` keeps all its columns.

    A comparison of times alone would be a nested loop. Here spans are put into slots of time and joined on key and
    slot. So that neither a long span takes thousands of slots nor a short one is met by a whole day's points, there
    are levels of slots, each `_WIDER` times as long as those below: a span lies on the lowest level on which it takes at
    most `pieces` slots, a point looks into its one slot on each level. A pair meets on one level, in one slot,
    so nothing is found twice. Levels follow from the first and last time of `points`, one pass over that column; spans
    are cut to that range, and a hot key is cut into slots on every level.
    """
    at = points.select(key, clock_seconds(points, time).alias("at")).where(F.col(key).isNotNull())
    lowest, highest = at.agg(F.min("at"), F.max("at")).first()
    if lowest is None:
        lowest = highest = 0
    sizes = _sizes(highest - lowest, slot_seconds, pieces)

    kind = points.schema[time].dataType
    held = spans.select(
        F.col(key).alias("_key"),
        F.col(start).cast(kind).alias("_start"),
        F.col(end).cast(kind).alias("_end"),
        F.struct(*(F.col(name) for name in values)).alias("_value"),
    ).where("_key is not null and _start is not null and (_end is null or _end > _start)")
    first = F.greatest(clock_seconds(held, "_start"), F.lit(lowest))
    last = F.least(F.coalesce(clock_seconds(held, "_end"), F.lit(highest)), F.lit(highest))
    held = held.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    held = held.withColumn("_size", _size_of_span(sizes, pieces))
    slots = F.sequence(_slot("_first", "_size"), _slot("_last", "_size"))
    held = held.select("_key", "_start", "_end", "_value", "_size", F.explode(slots).alias("_slot"))

    rows = points.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    rows = rows.select(
        F.col(key).alias("_key"),
        F.col(time).alias("_at"),
        clock_seconds(points, time).alias("_seconds"),
        F.struct("*").alias("_row"),
        F.explode(F.array(*(F.lit(size).cast("long") for size in sizes))).alias("_size"),
    ).withColumn("_slot", _slot("_seconds", "_size"))
    pairs = rows.join(held, ["_key", "_size", "_slot"]).where("_start <= _at and (_end is null or _at < _end)")
    return pairs.select("_row.*", *(F.col("_value")[name].alias(name) for name in values))


def _sizes(seconds: int, slot_seconds: int, pieces: int) -> list[int]:
    """Slot lengths of the levels; on the last one, the whole range takes at most `pieces` slots."""
    sizes = [slot_seconds]
    while seconds // sizes[-1] + 2 > max(pieces, 2):
        sizes.append(sizes[-1] * _WIDER)
    return sizes


def _slot(seconds: str, size: str) -> Column:
    """Whole numbers throughout, rounded down before 1970 as well."""
    return F.expr(f"({seconds} - pmod({seconds}, {size})) div {size}")


def _size_of_span(sizes: Sequence[int], pieces: int) -> Column:
    fits = [
        F.when(_slot("_last", f"{size}L") - _slot("_first", f"{size}L") < pieces, F.lit(size).cast("long"))
        for size in sizes[:-1]
    ]
    return F.coalesce(*fits, F.lit(sizes[-1]).cast("long"))
