"""Intermediate tables of the text operators, in the folder that the cluster shares."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from tidemark.llm.bitmap import filter_of
from tidemark.storage import delete, scratch_path


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read from there: computed once, its lineage cut, and safe
    against lost executors. The folder lasts as long as the session."""
    return _saved(df, scratch_path(df.sparkSession, name))


def _saved(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """`saved`, for tables that nothing reads after the block: they are deleted at its end."""
    made = []

    def saved_for_now(df: DataFrame, name: str) -> DataFrame:
        made.append((df.sparkSession, scratch_path(df.sparkSession, name)))
        return _saved(df, made[-1][1])

    try:
        yield saved_for_now
    finally:
        for spark, path in made:
            delete(spark, path)


def without_rows(df: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of `df` whose number `row` is not in `gone(row)`; both are read more than once.

    Only rows that a bitmap of `gone` lets through are shuffled and joined, all others stay where they are.
    """
    may = filter_of(gone.select("row"))
    return df.where(~may("row")).unionByName(df.where(may("row")).join(gone, "row", "left_anti"))
