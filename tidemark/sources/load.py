"""The two inputs of the job, in logical columns."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import on_days, same_text
from tidemark.names import PARTY, TRANSACTION_COLUMNS, TRANSACTIONS_SCHEMA, USER_COLUMNS, USERS_SCHEMA
from tidemark.sources.connections import connection
from tidemark.sources.jdbc import quote_name, quote_text
from tidemark.sources.read import FILE_TYPES, JDBC_TYPES, LANDING_TYPES, read_source, source_type


_SPLIT = {"partitioncolumn", "lowerbound", "upperbound", "numpartitions"}


def active_parties(spark: SparkSession, spec: Mapping[str, Any], source: str = "users") -> DataFrame:
    """Ids of the parties with the active status, in any case.

    On JDBC the filter goes to the database as SQL text, because Spark does not push `upper` down.
    """
    status = spec.get("business_logic", {}).get("active_status_value")
    if not status:
        raise ValueError("business_logic.active_status_value is required")
    entry = spec.get("data_sources", {}).get(source)
    if entry is None:
        return spark.createDataFrame([], USERS_SCHEMA)
    columns = physical_columns(spec, source, USER_COLUMNS)
    if source_type(entry) in JDBC_TYPES:
        url = connection(spec, entry)["url"]
        where = f"upper({quote_name(columns['status'], url)}) = upper({quote_text(status, url)})"
        users = _select_in_database(spark, spec, source, {PARTY: columns[PARTY]}, where)
    else:
        users = select_mapped(read_source(spark, spec, source), columns).where(same_text("status", status))
    return users.select(_id(PARTY))


def transactions(
    spark: SparkSession, spec: Mapping[str, Any], first: date | None, last: date, source: str = "transactions"
) -> DataFrame:
    """The transactions of `first` to `last`, both days whole, in the six logical columns; without a first
    day, all up to `last`.

    On files Spark pushes columns and bounds into the scan. A source laid out by day names that column
    as `partition_column`: the same days then choose the folders, so the others are not even listed. On
    JDBC the bounds are SQL text, so days are those of the database's clock, whatever the time zones of
    session and JVM.
    """
    entry = spec.get("data_sources", {}).get(source)
    if entry is None:
        return spark.createDataFrame([], TRANSACTIONS_SCHEMA)
    columns = physical_columns(spec, source, TRANSACTION_COLUMNS)
    if source_type(entry) in JDBC_TYPES:
        time = quote_name(columns["transaction_date"], connection(spec, entry)["url"])
        after = last + timedelta(days=1)
        where = f"{time} < {{ts '{after} 00:00:00'}}"
        if first is not None:
            where = f"{time} >= {{ts '{first} 00:00:00'}} AND {where}"
        rows = _select_in_database(spark, spec, source, columns, where, (columns["transaction_date"], first, after))
    else:
        rows = read_source(spark, spec, source)
        if folder := entry.get("partition_column"):
            require_columns(rows, [folder])
            inside = F.col(f"`{folder}`") <= F.lit(last.isoformat()).cast(rows.schema[folder].dataType)
            if first is not None:
                inside &= F.col(f"`{folder}`") >= F.lit(first.isoformat()).cast(rows.schema[folder].dataType)
            rows = rows.where(inside)
        rows = select_mapped(rows, columns).where(on_days("transaction_date", first, last))
    return rows.withColumns({name: _id(name) for name in ("sender_msisdn", "receiver_msisdn")})


def transaction_stream(
    spark: SparkSession, spec: Mapping[str, Any], source: str = "transactions", *, files_per_batch: int | None = None
) -> DataFrame:
    """The transactions of a file source as a stream of the files that arrive, in the six logical columns.

    The source's `schema` is what its files hold; without one it is that of the files that are there now.
    """
    entry = dict(spec["data_sources"][source])
    kind = source_type(entry)
    if kind not in FILE_TYPES and kind not in LANDING_TYPES:
        raise ValueError(f"source {source!r} of type {kind!r} has no files to follow")
    schema = entry.get("schema") or read_source(spark, spec, source).schema
    options = dict(entry.get("options_override") or {})
    if files_per_batch:
        options["maxFilesPerTrigger"] = files_per_batch
    file_format, path = LANDING_TYPES.get(kind) or kind.removesuffix("_file"), entry.get("path") or entry.get("remote_path")
    rows = spark.readStream.format(file_format).options(**options).schema(schema).load(path)
    rows = select_mapped(rows, physical_columns(spec, source, TRANSACTION_COLUMNS))
    return rows.withColumns({name: _id(name) for name in ("sender_msisdn", "receiver_msisdn")})


def _select_in_database(
    spark: SparkSession,
    spec: Mapping[str, Any],
    source: str,
    columns: Mapping[str, str],
    where: str,
    time: tuple[str, date | None, date] | None = None,
) -> DataFrame:
    """The physical columns under their logical names, filtered by the database.

    The scan is split over `numPartitions` connections, 8 if not stated, on the source's
    `partitionColumn`, else on the column of `time` (name, first day or None, day after the last) if it
    holds dates or times. It is split within the filtered rows, whatever bounds are given for the whole
    table, so a run over one day of a long table still spreads over all its splits.
    """
    entry = spec["data_sources"][source]
    if not entry.get("table"):
        raise ValueError(f"source {source!r} has no table")
    url = connection(spec, entry)["url"]
    selected = [f"{quote_name(physical, url)} AS {quote_name(logical, url)}" for logical, physical in columns.items()]
    given = {key.lower(): (key, value) for key, value in (entry.get("options_override") or {}).items()}
    override = {k: v for k, v in (entry.get("options_override") or {}).items() if k.lower() not in _SPLIT}
    filtered = {**spec, "data_sources": {source: {**entry, "options_override": override}}}
    options = {}
    split = given["partitioncolumn"][1] if "partitioncolumn" in given else None
    if split is None and time and str(given.get("numpartitions", ("", 8))[1]) != "1":
        nothing = f"SELECT {quote_name(time[0], url)} AS {quote_name('_split', url)} FROM {entry['table']} WHERE 1 = 0"
        kind = read_source(spark, filtered, source, query_string=nothing, query_alias="kind").dtypes[0][1]
        split = time[0] if kind in ("date", "timestamp") else None  # what Spark can split on
    if split:
        selected.append(f"{quote_name(split, url)} AS {quote_name('_split', url)}")
        options = {"partitionColumn": "_split", "numPartitions": given.get("numpartitions", ("", 8))[1]}
        if time and split == time[0] and time[1] is not None:
            options |= {"lowerBound": time[1].isoformat(), "upperBound": time[2].isoformat()}
    query = f"SELECT {', '.join(selected)} FROM {entry['table']} WHERE {where}"
    rows = read_source(spark, filtered, source, query_string=query, query_alias=f"{source}_query", **options)
    return select_mapped(rows, {logical: logical for logical in columns})


def _id(name: str) -> Column:
    """Ids are compared as text, whatever the source stores; on a text column the cast disappears."""
    return F.col(name).cast("string").alias(name)


def physical_columns(
    spec: Mapping[str, Any], source: str, defaults: Mapping[str, tuple[str, str]]
) -> dict[str, str]:
    """Logical to physical column, as mapped under `spec["columns"][source]` or by default."""
    mapped = spec.get("columns", {}).get(source, {})
    return {logical: mapped.get(key, physical) for logical, (key, physical) in defaults.items()}


def select_mapped(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The physical columns under their logical names."""
    require_columns(df, columns.values())
    return df.select(*[F.col(f"`{physical}`").alias(logical) for logical, physical in columns.items()])


def require_columns(df: DataFrame, names) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
