"""As-of join: for each row the last row of another table with the same key, at its time or before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import clock_seconds


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    time: str,
    values: Sequence[str],
    *,
    right_time: str | None = None,
    slot_seconds: int = 3600,
) -> DataFrame:
    """`left` with the `values` columns of `right`'s last row of the same key at the same time or before.

    Both tables name their key `key`; `right_time` is the right one's time where that has another name. Rows of
    `left` without a match, a key or a time get nulls; rows of `right` without a key or a time match nothing. Of
    right rows of one key and time the one of least values counts, nulls first.

    A window over a key would sort all its rows in one task. Here both tables are cut into slots of time
    and put together, a row looks for its match within its slot, and what a slot begins with is carried
    from the slots before, which have one row each. A task sorts one slot of a key; the carried rows of a key
    are bounded by the number of slots in the calendar.
    """
    right_time = right_time or time
    order = [F.col(name) for name in values]
    value = F.struct(*order).alias("_value")
    known = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull())
    known = known.groupBy(F.col(key).alias("_key"), F.col(right_time).alias("_at")).agg(F.min(value).alias("_value"))
    rows = left.select(F.col(key).alias("_key"), F.col(time).alias("_at"), F.struct("*").alias("_row"))
    kinds = {name: rows.schema[name].dataType for name in ("_key", "_at", "_row")}
    empty = F.lit(None).cast(known.schema["_value"].dataType)
    both = rows.withColumn("_value", empty).unionByName(
        known.select("_key", "_at", F.lit(None).cast(kinds["_row"]).alias("_row"), "_value")
    )
    both = both.withColumn("_slot", F.floor(clock_seconds(both, "_at") / slot_seconds))

    # At equal times the right row comes first.
    here = Window.partitionBy("_key", "_slot").orderBy("_at", F.col("_row").isNotNull())
    here = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_here", F.last("_value", ignorenulls=True).over(here)).where("_row is not null")

    ends = both.where("_key is not null and _slot is not null").groupBy("_key", "_slot")
    ends = ends.agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_at"))).alias("_end"))
    before = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_key", "_slot", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    joined = found.join(carried.where("_carried is not null"), ["_key", "_slot"], "left")
    match = F.coalesce("_here", "_carried")
    return joined.select("_row.*", *(match[name].alias(name) for name in values))
