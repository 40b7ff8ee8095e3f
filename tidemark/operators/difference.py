"""What changed between two snapshots, as rows that can be applied."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.names import PARTY

APPEARED, VANISHED, CHANGED = "appeared", "vanished", "changed"


def snapshot_difference(old: DataFrame, new: DataFrame, keys: Sequence[str] = (PARTY,)) -> DataFrame:
    """One row per key whose row is not the same in both snapshots: the keys, `change`, and the other columns of `old`
    as `old_…` and of `new` as `new_…`.

    Both snapshots have the same columns and at most one row per key. Nulls are equal to nulls, in keys and values.
    Both sides go into one aggregate by key, which combines rows before its shuffle: a key has two rows at the most,
    so no key can be hot, and no null key is lost as in a join.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError(f"snapshots differ in columns: {', '.join(sorted(set(old.columns) ^ set(new.columns)))}")
    others = [name for name in old.columns if name not in keys]
    whole = F.struct(*others, F.lit(True).alias("_is"))
    sides = old.select(*keys, whole.alias("_old"), F.lit(None).alias("_new")).unionByName(
        new.select(*keys, F.lit(None).alias("_old"), whole.alias("_new"))
    )
    both = sides.groupBy(*keys).agg(F.first("_old", True).alias("_old"), F.first("_new", True).alias("_new"))
    change = F.when(F.col("_old").isNull(), APPEARED).when(F.col("_new").isNull(), VANISHED).otherwise(CHANGED)
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(
        *keys,
        change.alias("change"),
        *(F.col("_old")[name].alias(f"old_{name}") for name in others),
        *(F.col("_new")[name].alias(f"new_{name}") for name in others),
    )


def apply_difference(old: DataFrame, changes: DataFrame, keys: Sequence[str] = (PARTY,)) -> DataFrame:
    """The later snapshot: `old` without the keys that changed or vanished, and the new rows of those that
    changed or appeared."""
    others = [name for name in old.columns if name not in keys]
    gone = changes.where(F.col("change") != APPEARED).select(*(F.col(name).alias(f"_{name}") for name in keys))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys]
    kept = old.join(gone, same, "left_anti")
    came = changes.where(F.col("change") != VANISHED)
    return kept.unionByName(came.select(*keys, *(F.col(f"new_{name}").alias(name) for name in others)))
