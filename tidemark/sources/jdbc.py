"""JDBC tables and queries."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, options: Mapping[str, Any], table: str) -> DataFrame:
    """A table, or any `(query) AS alias`.

    With `partitionColumn` and `numPartitions` the scan is split over the cluster; without them JDBC
    gives one partition. Bounds left out are asked from the database (one row); they only place the
    splits, rows outside them and rows with a null are still read.
    """
    options = dict(options)
    given = {key.lower(): value for key, value in options.items()}  # Spark does not mind the case either
    column = given.get("partitioncolumn")
    if column and not {"lowerbound", "upperbound"} <= given.keys():
        options = {k: v for k, v in options.items() if k.lower() not in ("lowerbound", "upperbound")}
        options.update(_bounds(spark, options, table, column))
    return spark.read.format("jdbc").options(**options, dbtable=table).load()


def read_query(spark: SparkSession, options: Mapping[str, Any], query: str, alias: str) -> DataFrame:
    """The result of a query the database runs, for predicates Spark does not push down."""
    if not alias:
        raise ValueError("a query needs an alias")
    return read_table(spark, options, f"({query.strip()}) AS {alias}")


def _bounds(spark: SparkSession, options: Mapping[str, Any], table: str, column: str) -> dict[str, str]:
    """Smallest and greatest value of the column, computed by the database."""
    name = quote_name(column, options["url"])
    single = {k: v for k, v in options.items() if k.lower() not in ("partitioncolumn", "numpartitions")}
    ends = read_query(spark, single, f"SELECT min({name}) AS lo, max({name}) AS hi FROM {table}", "ends")
    kind = ends.dtypes[0][1]
    dated = kind == "date" or kind.startswith("timestamp")
    low, high = ends.select([F.col(c).cast("string" if dated else "long") for c in ends.columns]).first()
    if low is None:  # empty table: any bounds will do
        low = high = "1970-01-01" if dated else 0
    return {"lowerBound": str(low), "upperBound": str(high)}


def quote_name(name: str, url: str) -> str:
    """A column name as the database at `url` quotes it."""
    if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        return "`" + name.replace("`", "``") + "`"
    if url.startswith("jdbc:sqlserver:"):
        return "[" + name.replace("]", "]]") + "]"
    return '"' + name.replace('"', '""') + '"'


def quote_text(value: str, url: str) -> str:
    """A string literal for the database at `url`."""
    if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        value = value.replace("\\", "\\\\")
    return "'" + value.replace("'", "''") + "'"
