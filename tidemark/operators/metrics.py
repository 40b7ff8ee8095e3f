"""Row counts per stage without a pass of their own."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StageCounts:
    """Counts rows while the one job that needs them anyway reads them.

    Wrap each DataFrame once, run the action under `whole_plans`, then ask for `result()`. A stage that
    Spark has to run again after losing an executor may be counted twice: use the numbers for logs, not
    for decisions.
    """

    def __init__(self) -> None:
        self._stages: dict[str, Observation] = {}

    def __call__(self, stage: str, df: DataFrame) -> DataFrame:
        self._stages[stage] = Observation()
        return df.observe(self._stages[stage], F.count(F.lit(1)).alias("rows"))

    def result(self) -> dict[str, int]:
        """Rows per stage."""
        return {stage: seen.get["rows"] for stage, seen in self._stages.items()}


_RULES = {
    "spark.sql.optimizer.excludedRules": "org.apache.spark.sql.catalyst.optimizer.PropagateEmptyRelation",
    "spark.sql.adaptive.optimizer.excludedRules": "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation",
}


@contextmanager
def whole_plans(spark: SparkSession) -> Iterator[None]:
    """Keeps Spark from leaving out stages because another input turned out empty: they would not be counted.

    The session's own settings come back at the end.
    """
    before = {key: spark.conf.get(key, None) for key in _RULES}
    try:
        for key, rule in _RULES.items():
            spark.conf.set(key, ",".join(filter(None, (before[key], rule))))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
