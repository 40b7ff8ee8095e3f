"""Generic write by logical name."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame

from tidemark.sources.connections import connection, merge_options, mongo_options
from tidemark.sources.read import FILE_TYPES, JDBC_TYPES, LANDING_TYPES, TABLE_TYPE

MODES = ("append", "overwrite", "ignore", "error", "errorifexists")


def output_type(entry: Mapping[str, Any]) -> str:
    """The stated type, or the one the other keys of an output imply."""
    if kind := entry.get("output_type"):
        return kind.lower()
    name = entry.get("connection_name")
    if entry.get("table") and name:
        return "jdbc_table"
    if entry.get("collection") and name:
        return "mongo_collection"
    if entry.get("path") and not name:
        return "parquet_file"
    if "sftp" in (name or "").lower():
        return "sftp_file"
    raise ValueError("output type is not stated and cannot be told from the other keys")


def replaces_partitions(entry: Mapping[str, Any]) -> bool:
    """Whether writing to this output touches only the partitions at hand, so that empty does no harm."""
    return (
        output_type(entry) in (*FILE_TYPES, "text_file")
        and bool(entry.get("partition_by"))
        and (entry.get("options_override") or {}).get("partitionOverwriteMode", "dynamic") == "dynamic"
    )


def write_output(
    df: DataFrame | None,
    spec: Mapping[str, Any],
    name: str,
    *,
    skip_empty: bool = True,
    rebalance: bool = True,
    **kwargs: Any,
) -> bool:
    """Writes to the output `name` of `spec["outputs"]`; False when there was nothing to write.

    The mode is `kwargs["mode"]`, else the output's `mode`, else overwrite (append on a drop folder).
    `partition_by` files are rebalanced by those columns first, so a day becomes a few full files and
    a heavy day several tasks. Pass `rebalance=False` to save that shuffle where `df` holds a single
    partition anyway. An overwrite replaces only the partitions present in `df`, unless the option
    `partitionOverwriteMode` says `static`.

    The emptiness test evaluates `df` up to its first row. Pass `skip_empty=False` where an empty
    write does no harm.
    """
    try:
        entry = spec["outputs"][name]
    except KeyError:
        raise ValueError(f"output {name!r} is not defined") from None
    kind = output_type(entry)
    if kind == TABLE_TYPE and not entry.get("table"):
        raise ValueError(f"output {name!r} has no table")
    own = {k: v for k, v in {**(entry.get("options_override") or {}), **kwargs}.items() if v is not None}
    mode = own.pop("mode", None) or entry.get("mode") or ("append" if kind in LANDING_TYPES else "overwrite")
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} of output {name!r} is not one of {', '.join(MODES)}")
    if "output_filename_pattern" in {**entry, **own}:
        raise ValueError(f"output {name!r}: files keep Spark's names; output_filename_pattern is not supported")
    if df is None or (skip_empty and df.isEmpty()):
        return False

    if kind in JDBC_TYPES:
        options = {**merge_options(connection(spec, entry), own), "dbtable": _required(entry, "table", name)}
        df.write.format("jdbc").mode(mode).options(**options).save()
    elif kind == "mongo_collection":
        options = mongo_options(merge_options(connection(spec, entry), own), _required(entry, "collection", name))
        df.write.format("mongodb").mode(mode).options(**options).save()
    elif kind in (*FILE_TYPES, "text_file"):
        _write_files(df, kind.removesuffix("_file"), _required(entry, "path", name), mode, entry, own, rebalance)
    elif kind in LANDING_TYPES:
        _write_files(df, LANDING_TYPES[kind], _required(entry, "remote_base_path", name), mode, entry, own, rebalance)
    elif kind == TABLE_TYPE:
        _write_table(df, mode, entry, own)
    else:
        raise NotImplementedError(f"output type {kind!r}")
    return True


def _write_table(df: DataFrame, mode: str, entry: Mapping[str, Any], options: Mapping[str, Any]) -> None:
    """A table of the session's catalog, in `buckets` buckets by `bucket_by` if stated, each sorted by `sort_by`.

    Rows are dealt to the buckets by one shuffle, so a bucket is one file and later joins and aggregates by those
    columns need none. A bucket is read by one task: a key with a large share of all rows makes a large
    one, so bucket by that key only what is joined by it row for row, and give enough buckets for a file to fit a task.
    """
    columns = [entry["bucket_by"]] if isinstance(entry.get("bucket_by"), str) else list(entry.get("bucket_by") or [])
    order = [entry["sort_by"]] if isinstance(entry.get("sort_by"), str) else list(entry.get("sort_by") or columns)
    if not columns:
        df.write.mode(mode).options(**options).saveAsTable(entry["table"])
        return
    buckets = int(entry.get("buckets") or 0)
    if buckets < 1:
        raise ValueError(f"table {entry['table']!r} is bucketed without a number of buckets")
    writer = df.repartition(buckets, *columns).write.mode(mode).options(**options)
    writer.bucketBy(buckets, *columns).sortBy(*order).saveAsTable(entry["table"])


def _write_files(
    df: DataFrame,
    file_format: str,
    path: str,
    mode: str,
    entry: Mapping[str, Any],
    options: dict[str, Any],
    rebalance: bool,
) -> None:
    """Files at any Hadoop URI, written by the executors."""
    days = entry.get("partition_by") or []
    days = [days] if isinstance(days, str) else list(days)
    if file_format == "text":
        rest = [(column, kind) for column, kind in df.dtypes if column not in days]
        if len(rest) != 1 or rest[0][1] != "string":
            raise ValueError(f"a text file holds one string column, not {rest}")
    if days:
        # Only adaptive execution splits a heavy day again; without it one task would write the day.
        if rebalance and df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            df = df.hint("rebalance", *days)
        options.setdefault("partitionOverwriteMode", "dynamic")
    df.write.format(file_format).mode(mode).options(**options).partitionBy(*days).save(path)


def _required(entry: Mapping[str, Any], key: str, name: str) -> str:
    if not entry.get(key):
        raise ValueError(f"output {name!r} has no {key}")
    return entry[key]
