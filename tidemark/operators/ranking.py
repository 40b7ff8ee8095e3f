"""Full ranking of a party's events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.names import CATEGORY, PARTY, TIME
from tidemark.operators.latest import latest_first

_BLOCK = 100_000  # rows that one row of copies is written out to at a time
_LARGE = 500_000  # different events of a party, or of a party and hour, beyond which they are cut into hours, or seconds
_CELLS = 1 << 16  # groups of parties whose events are counted to find large parties


def rank_events(events: DataFrame, rank: str = "rn") -> DataFrame:
    """Adds 1, 2, 3 … per party, newest event first: `row_number` in the order of `latest_first`.

    A plain window would sort all events of a party in one task. Here equal events are counted
    before the shuffle, and a large party is cut into slots of an hour, or of a second where an hour is large, and a
    slot starts where the newer slots end. A task sorts one slot of different events; the running total
    over slots has at most one row per party and slot.

    Other parties have one window each and are shuffled once for it. A large one is found by the number of different events
    of its cell, a hash of the party: as there are few cells, their counts are small on every task. What
    shares a cell with a large party is cut, too.

    Expects events as `party_events` returns them: the party is never null.
    """
    distinct = events.groupBy(PARTY, TIME, CATEGORY).agg(F.count(F.lit(1)).alias("copies"))
    distinct = distinct.withColumn("cell", F.pmod(F.xxhash64(PARTY), F.lit(_CELLS)))
    cells = distinct.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > _LARGE)
    cells = F.broadcast(cells.select("cell", F.lit(True).alias("cut")))  # at most _CELLS rows
    distinct = distinct.join(cells, "cell", "left").drop("cell")

    newer_here = Window.partitionBy(PARTY).orderBy(*latest_first()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("copies").over(newer_here), F.lit(0)).alias("before")
    whole = distinct.where("cut is null").select(PARTY, TIME, CATEGORY, "copies", before)
    return _one_row_per_copy(whole.unionByName(_by_slots(distinct.where("cut").drop("cut"))), rank)


def _by_slots(distinct: DataFrame) -> DataFrame:
    """Counted events of large parties with the number of newer ones, `before`."""
    distinct = distinct.withColumn("at", F.coalesce(clock_seconds(distinct, TIME), F.lit(-(2**62))))  # no time: after every dated slot
    distinct = distinct.withColumn("hour", F.expr("at div 3600"))

    # At most one event in _LARGE names a large hour. Whether that is few enough to broadcast, Spark sees at run time.
    hours = distinct.groupBy(PARTY, "hour").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("rows"))
    large = hours.where(F.col("rows") > _LARGE).select(PARTY, "hour", F.lit(True).alias("large"))
    cut = distinct.join(large, [PARTY, "hour"], "left")
    cut = cut.withColumn("slot", F.when(F.col("large"), F.col("at"))).drop("at", "large")
    seconds = cut.where("slot is not null").groupBy(PARTY, "hour", "slot").agg(F.sum("copies").alias("n"))
    whole = hours.where(F.col("rows") <= _LARGE).select(PARTY, "hour", F.lit(None).cast("long").alias("slot"), "n")

    newer = Window.partitionBy(PARTY).orderBy(F.desc("hour"), F.desc("slot"))
    newer = newer.rowsBetween(Window.unboundedPreceding, -1)
    slots = whole.unionByName(seconds).select(
        PARTY,
        F.col("hour").alias("_hour"),
        F.coalesce("slot", F.lit(0)).alias("_slot"),
        F.coalesce(F.sum("n").over(newer), F.lit(0)).alias("before_slot"),
    )

    cut = cut.withColumns({"_hour": F.col("hour"), "_slot": F.coalesce("slot", F.lit(0))})
    same = [PARTY, "_hour", "_slot"]
    newer_here = Window.partitionBy(*same).orderBy(*latest_first()).rowsBetween(Window.unboundedPreceding, -1)
    return cut.join(slots, same).select(
        PARTY,
        TIME,
        CATEGORY,
        "copies",
        (F.col("before_slot") + F.coalesce(F.sum("copies").over(newer_here), F.lit(0))).alias("before"),
    )


def clock_seconds(df: DataFrame, name: str) -> Column:
    """Seconds that never run backwards: of the epoch, or of the clock where times have no zone."""
    if dict(df.dtypes)[name] == "timestamp":
        return F.unix_seconds(name)
    time = F.col(name).cast("timestamp_ntz")
    hours = F.unix_date(F.to_date(time)).cast("long") * 24 + F.hour(time)
    return hours * 3600 + F.minute(time) * 60 + F.second(time)


def _one_row_per_copy(placed: DataFrame, rank: str) -> DataFrame:
    """Repeats a counted row `copies` times with consecutive ranks, in blocks: an event with billions of
    copies does not build one huge array."""
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(_BLOCK).cast("long")))
    blocks = placed.withColumn("skip", first)
    size = F.least(F.col("copies") - F.col("skip"), F.lit(_BLOCK))
    start = F.col("before") + F.col("skip")
    return blocks.select(PARTY, TIME, CATEGORY, F.explode(F.sequence(start + 1, start + size)).alias(rank))
