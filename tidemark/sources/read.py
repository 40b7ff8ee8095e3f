"""Generic read by logical name."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.sources import jdbc
from tidemark.sources.connections import connection, merge_options, mongo_options

JDBC_TYPES = ("jdbc_table", "mariadb_table", "mysql_table", "postgres_table", "sqlserver_table")
FILE_TYPES = ("parquet_file", "csv_file", "json_file", "orc_file")
LANDING_TYPES = {"sftp_file": "text", "sftp_csv": "csv", "sftp_parquet": "parquet"}
TABLE_TYPE = "catalog_table"
_JDBC_DATABASES = ("mariadb", "mysql", "postgres", "sqlserver", "jdbc")


def source_type(entry: Mapping[str, Any]) -> str:
    """The stated type, or the one the other keys of a source imply."""
    if kind := entry.get("source_type"):
        return kind.lower()
    database = (entry.get("db_type") or "").lower()
    if database == "mongodb":
        return "mongo_collection"
    if database in _JDBC_DATABASES:
        return "jdbc_table"
    if "sftp" in (entry.get("connection_name") or "").lower():
        return "sftp_file"
    if entry.get("path"):
        kind = (entry.get("format") or "parquet").lower()
        return kind if kind.endswith("_file") else f"{kind}_file"
    raise ValueError("source type is not stated and cannot be told from the other keys")


def read_source(spark: SparkSession, spec: Mapping[str, Any], name: str, **kwargs: Any) -> DataFrame:
    """The source `name` of `spec["data_sources"]` as a DataFrame.

    Reader options come from the connection, then the source's `options_override`, then `kwargs`. These
    keywords are not options: `query_string` and `query_alias` (JDBC), `pipeline` (document store),
    `schema` (StructType or DDL), `file_pattern`, `remote_path` (drop folder).
    """
    try:
        entry = spec["data_sources"][name]
    except KeyError:
        raise ValueError(f"source {name!r} is not defined") from None
    kind = source_type(entry)
    own = {k: v for k, v in {**(entry.get("options_override") or {}), **kwargs}.items() if v is not None}
    take = own.pop

    if kind in JDBC_TYPES:
        query, alias = take("query_string", None), take("query_alias", f"{name}_q")
        options = merge_options(connection(spec, entry), own)
        if query:
            return jdbc.read_query(spark, options, query, alias)
        if not entry.get("table"):
            raise ValueError(f"source {name!r} needs a table or a query")
        return jdbc.read_table(spark, options, entry["table"])

    if kind == TABLE_TYPE:
        if not entry.get("table"):
            raise ValueError(f"source {name!r} has no table")
        return spark.read.options(**own).table(entry["table"])

    schema = _schema(take("schema", None))
    if kind == "mongo_collection":
        pipeline = take("pipeline", None)
        options = merge_options(connection(spec, entry), own)
        options = mongo_options(options, entry.get("collection"), pipeline)
        return _load(spark, "mongodb", options, schema)

    pattern = take("file_pattern", None)
    if kind in FILE_TYPES:
        path, file_format = entry.get("path"), kind.removesuffix("_file")
    elif kind in LANDING_TYPES:
        path, file_format = take("remote_path", entry.get("remote_path")), LANDING_TYPES[kind]
    else:
        raise NotImplementedError(f"source type {kind!r}")
    if not path:
        raise ValueError(f"source {name!r} has no path")
    return _read_files(spark, file_format, path, pattern, schema, own)


def _read_files(
    spark: SparkSession,
    file_format: str,
    path: str,
    pattern: str | None,
    schema: StructType | str | None,
    options: Mapping[str, Any],
) -> DataFrame:
    """Files at any Hadoop URI, read by the executors.

    `pattern` is a shell pattern below `path`; one that reaches into sub-folders keeps their partition
    columns. When no file matches, the result is empty if a schema is stated, an error otherwise.
    """
    if file_format == "text":
        schema = schema or "value string"
    options = {"basePath": path, **options} if "/" in (pattern or "") else options
    target = f"{path.rstrip('/')}/{_hadoop_glob(pattern)}" if pattern else path
    try:
        return _load(spark, file_format, options, schema, target)
    except AnalysisException as error:
        nothing = "PATH_NOT_FOUND" if pattern else "UNABLE_TO_INFER_SCHEMA"
        if error.getCondition() != nothing:
            raise
        if schema is None:
            raise ValueError(f"no file {pattern or '*'} in {path}; state a schema to read it as empty") from error
    _load(spark, file_format, {}, schema, path)  # a missing folder stays an error
    return spark.createDataFrame([], schema)


def _load(spark, file_format, options, schema, *path) -> DataFrame:
    reader = spark.read.format(file_format).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(*path)


def _schema(schema: Any) -> StructType | str | None:
    if schema is None or isinstance(schema, (StructType, str)):
        return schema
    raise TypeError(f"schema must be a StructType or a DDL string, not {type(schema).__name__}")


def _hadoop_glob(pattern: str) -> str:
    """Shell pattern to Hadoop glob: braces are plain characters, `[!…]` is `[^…]`."""
    return pattern.replace("{", "\\{").replace("}", "\\}").replace("[!", "[^")
