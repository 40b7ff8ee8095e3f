"""Distinct counts and percentiles that are kept per day and merged over any days."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXACT = 2048  # different keys, and different values, that a day's row lists
LOG_K = 14  # sketch of keys: 2 ** 14 registers, standard error 0.8 %
ERROR = 0.01  # relative error of a percentile beyond the lists
_GROWTH = (1 + ERROR) / (1 - ERROR)  # a bucket's upper bound by its lower one
_PARTS = 64  # parts that the keys of a day's row are counted in


def daily_sketches(
    events: DataFrame, by: Sequence[str], time: str, key: str, value: str, *, exact: int = EXACT, day: str = "day"
) -> DataFrame:
    """One row per day and combination of the `by` columns, from which `merge_sketches` counts keys and ranks values.

    Columns: `day`, those of `by`, `events`; `keys`, the different keys, and `key_sketch`, a HyperLogLog sketch of them;
    `values`, the different values with their numbers, and `buckets`, the numbers of values in logarithmic buckets. Lists are null where a row
    would have more than `exact` entries. Rows without a time are left out; a null key, and a value that is null, NaN
    or infinite, only counts as an event; null `by` columns form combinations of their own.

    The events are read once and nothing is joined. Each gives its key and its value, which are counted before the shuffle
    and dealt by day, combination and item, then by parts of the keys and buckets of the values, so that a combination with
    a third of all events lies in no single task; only a row per part and bucket, with at most `exact` items, goes on. A
    row is bounded by `exact`, the registers and the buckets: a few hundred, 140,000 if the values were all doubles.
    """
    number = F.col(value).cast("double")
    usable = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    # One item each for the key, the value, and the event itself.
    no_key, no_value = F.lit(None).cast("string"), F.lit(None).cast("double")
    items = F.array(
        _item(F.col(key).cast("string"), no_value, 0), _item(no_key, F.when(usable, number + 0.0), 1), _item(no_key, no_value, 2)
    )
    dated = events.where(F.col(time).isNotNull())
    rows = dated.select(_group([F.to_date(time).alias(day), *by]), items.alias("items"))
    rows = rows.select("_group", F.explode("items").alias("item"))
    rows = rows.where("item.kind = 2 or item.key is not null or item.value is not null")
    counted = rows.groupBy("_group", "item.kind", "item.key", "item.value").agg(F.count(F.lit(1)).alias("n"))

    # Cells: logarithmic buckets of values, parts of the keys. No more items of a cell than fit a list are put into one.
    cell = F.when(F.col("kind") == 0, F.pmod(F.hash("key"), F.lit(_PARTS))).when(F.col("kind") == 1, _bucket("value")).otherwise(0)
    place = F.row_number().over(Window.partitionBy("_group", "kind", "cell").orderBy("key", "value"))
    cells = counted.withColumn("cell", cell).withColumn("place", place).groupBy("_group", "kind", "cell").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("items"),
        F.hll_sketch_agg("key", LOG_K).alias("sketch"),
        F.collect_list(F.when(F.col("place") <= exact, F.struct("key", "value", "n"))).alias("list"),
    )

    def listed(kind: int, item: Callable[[Column], Column]) -> Column:
        lists = F.flatten(F.collect_list(F.when((F.col("kind") == kind) & (F.col("items") <= exact), F.col("list"))))
        size = F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("items"))), F.lit(0))
        return F.when(size <= exact, F.array_sort(F.transform(lists, item)))

    buckets = F.collect_list(F.when(F.col("kind") == 1, F.struct(F.col("cell").alias("bucket"), "n")))
    return (
        cells.groupBy("_group")
        .agg(
            F.sum(F.when(F.col("kind") == 2, F.col("n"))).alias("events"),
            listed(0, lambda item: item["key"]).alias("keys"),
            F.hll_union_agg("sketch").alias("key_sketch"),
            listed(1, lambda item: F.struct(item["value"].alias("value"), item["n"].alias("n"))).alias("values"),
            F.array_sort(buckets).alias("buckets"),
        )
        .select("_group.*", "events", "keys", "key_sketch", "values", "buckets")
    )


def merge_sketches(
    sketches: DataFrame,
    by: Sequence[str],
    percents: Sequence[int],
    *,
    first: date | None = None,
    last: date | None = None,
    day: str = "day",
) -> DataFrame:
    """Events, different keys and percentiles over the days `first` to `last`, per combination of some of the `by` columns.

    Columns: those of `by`, `events`, `keys`, `keys_exact`, then `p50` and so on, and `values_exact`. The percentile p is
    the least value that at least p hundredths of the values do not exceed; null without values. Where every row
    merged has its lists, the result is exact, and `..._exact` says so; that holds whenever what the days have together
    is within the lists. Else the keys are estimated with a standard error of 0.8 %, and a percentile is
    within 1 % of the exact one. No events are read; without rows there is no result, not even for an empty `by`.
    """
    if any(not 0 < p <= 100 for p in percents):
        raise ValueError("percents lie above 0 and up to 100")
    rows = sketches
    if first is not None:
        rows = rows.where(F.col(day) >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col(day) <= F.lit(last))
    rows = rows.select(_group(by), "events", "keys", "key_sketch", "values", "buckets")
    whole = rows.groupBy("_group").agg(
        F.sum("events").alias("events"),
        F.hll_sketch_estimate(F.hll_union_agg("key_sketch")).alias("_estimate"),
        F.bool_and(F.col("keys").isNotNull()).alias("keys_exact"),
        F.bool_and(F.col("values").isNotNull()).alias("values_exact"),
    )
    keys = rows.select("_group", F.explode("keys").alias("key")).distinct().groupBy("_group").agg(F.count(F.lit(1)).alias("_counted"))

    # Values themselves, or the middles of their buckets: never both in one combination.
    middles = F.transform("buckets", lambda b: F.struct(_middle(b["bucket"]).alias("value"), b["n"].alias("n")))
    found = rows.join(whole.select("_group", "values_exact"), "_group")
    found = found.select("_group", F.explode(F.when(F.col("values_exact"), F.col("values")).otherwise(middles)).alias("item"))
    found = found.groupBy("_group", F.col("item.value").alias("value")).agg(F.sum("item.n").alias("n"))
    upwards = Window.partitionBy("_group").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = found.select("_group", "value", F.sum("n").over(upwards).alias("_up_to"))
    total = found.groupBy("_group").agg(F.sum("n").alias("_all"))
    reached = [F.min(F.when(F.expr(f"100 * _up_to >= {int(p)} * _all"), F.col("value"))).alias(f"p{int(p)}") for p in percents]
    points = ranked.join(total, "_group").groupBy("_group").agg(F.count(F.lit(1)).alias("_different"), *reached)

    merged = whole.join(keys, "_group", "left").join(points, "_group", "left")
    count = F.when(F.col("keys_exact"), F.coalesce("_counted", F.lit(0))).otherwise(F.col("_estimate")).cast("long")
    names = [f"_group.{name}" for name in by]
    return merged.select(*names, "events", count.alias("keys"), "keys_exact", *(f"p{int(p)}" for p in percents), "values_exact")


def _item(key: Column, value: Column, kind: int) -> Column:
    return F.struct(key.alias("key"), value.alias("value"), F.lit(kind).alias("kind"))


def _group(columns: Sequence[Column | str]) -> Column:
    """Columns as one that is never null, so that nulls in them are equal when joined."""
    return F.struct(*columns, *([] if columns else [F.lit(0).alias("_all")])).alias("_group")


def _bucket(value: str) -> Column:
    """Number of a value's bucket: all values in it are within `ERROR` of its middle. 0 holds zero alone, odd numbers hold
    values above zero and even ones those below."""
    # Doubles lie within 2 ** -1074 and 2 ** 1024, so that no number is below 1.
    place = F.ceil(F.log(F.abs(F.col(value))) / math.log(_GROWTH)).cast("int") + F.lit(_PLACES)
    return F.when(F.col(value) == 0, F.lit(0)).when(F.col(value) > 0, 2 * place + 1).otherwise(2 * place)


def _middle(bucket: Column) -> Column:
    place = F.floor(bucket / 2) - F.lit(_PLACES)
    size = F.exp(place * math.log(_GROWTH)) * (2 / (_GROWTH + 1))
    return F.when(bucket == 0, F.lit(0.0)).when(bucket % 2 == 1, size).otherwise(-size)


_PLACES = math.ceil(1075 * math.log(2) / math.log(_GROWTH)) + 1
