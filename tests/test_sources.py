import json
import logging
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.sources import active_parties, connections, read_source, require_columns, source_type, transactions
from tidemark.sources.jdbc import quote_name, quote_text
from tidemark.sources.read import _hadoop_glob
from tidemark.storage import materialised, scratch_path


@pytest.mark.parametrize(
    "entry, expected",
    [
        ({"source_type": "CSV_File", "db_type": "mongodb"}, "csv_file"),
        ({"db_type": "mongodb", "connection_name": "sftp1"}, "mongo_collection"),
        ({"db_type": "mariadb"}, "jdbc_table"),
        ({"db_type": "mysql"}, "jdbc_table"),
        ({"db_type": "postgres"}, "jdbc_table"),
        ({"db_type": "sqlserver"}, "jdbc_table"),
        ({"db_type": "jdbc"}, "jdbc_table"),
        ({"connection_name": "Partner_SFTP", "path": "/x"}, "sftp_file"),
        ({"path": "/x"}, "parquet_file"),
        ({"path": "/x", "format": "csv"}, "csv_file"),
        ({"path": "/x", "format": "orc_file"}, "orc_file"),
    ],
)
def test_source_type(entry, expected):
    assert source_type(entry) == expected


def test_unclear_source():
    with pytest.raises(ValueError):
        source_type({"connection_name": "db"})


def test_unknown_names_and_types(spark):
    with pytest.raises(ValueError, match="'x' is not defined"):
        read_source(spark, {}, "x")
    with pytest.raises(NotImplementedError):
        read_source(spark, {"data_sources": {"x": {"source_type": "xml_file", "path": "/x"}}}, "x")
    with pytest.raises(ValueError, match="connection 'db'"):
        read_source(spark, {"data_sources": {"x": {"db_type": "jdbc", "connection_name": "db", "table": "t"}}}, "x")
    with pytest.raises(ValueError, match="no path"):
        read_source(spark, {"data_sources": {"x": {"source_type": "csv_file"}}}, "x")


def test_options_are_merged_once_and_identity_is_protected(caplog):
    base = {"url": "jdbc:x", "user": "u", "password": "p", "fetchsize": 10}
    with caplog.at_level(logging.WARNING):
        merged = connections.merge_options(base, {"fetchsize": 20, "PassWord": "q"}, {"queryTimeout": 5, "url": "jdbc:y"})
    assert merged == {"url": "jdbc:x", "user": "u", "password": "p", "fetchsize": 20, "queryTimeout": 5}
    assert "PassWord" in caplog.text and "'q'" not in caplog.text


def test_document_store_options():
    base = {"connection.uri": "mongodb://h", "database": "d"}
    options = connections.merge_options(base, {"readPreference.name": "secondary", "connection.uri": "mongodb://other"})
    assert connections.mongo_options(options, "c") == {**base, "readPreference.name": "secondary", "collection": "c"}
    stages = [{"$match": {"status": "A"}}, {"$project": {"_id": 0}}]
    assert json.loads(connections.mongo_options(options, "c", stages)["aggregation.pipeline"]) == stages
    assert connections.mongo_options(options, "c", "[{}]")["aggregation.pipeline"] == "[{}]"
    for wrong, error in (([], ValueError), ("", ValueError), ({"$match": 1}, TypeError)):
        with pytest.raises(error):
            connections.mongo_options(options, "c", wrong)
    with pytest.raises(ValueError):
        connections.mongo_options(options, None)


def test_document_store_uses_the_connector(spark):
    """The connector is not on the class path here, so Spark must fail to find `mongodb`, not anything else."""
    spec = {
        "connections": {"docs": {"connection.uri": "mongodb://nowhere", "database": "d"}},
        "data_sources": {"x": {"db_type": "mongodb", "connection_name": "docs", "collection": "c"}},
    }
    with pytest.raises(Exception, match="mongodb"):
        read_source(spark, spec, "x", pipeline=[{"$match": {}}])


def test_schema_on_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;name\n1;x\n2;\n")
    spec = {"data_sources": {"x": {"path": str(tmp_path), "format": "csv", "options_override": {"sep": ";", "header": True}}}}
    assert read_source(spark, spec, "x").dtypes == [("id", "string"), ("name", "string")]
    assert read_source(spark, spec, "x", inferSchema=True).dtypes[0] == ("id", "int")
    assert read_source(spark, spec, "x", schema="id long, name string").dtypes[0] == ("id", "bigint")
    typed = StructType([StructField("id", LongType())])
    assert read_source(spark, spec, "x", schema=typed, enforceSchema=False).select("id").count() == 2
    with pytest.raises(TypeError):
        read_source(spark, spec, "x", schema={"id": "long"})


def test_multi_line_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"a": 1},\n{"a": 2}\n]')
    spec = {"data_sources": {"x": {"source_type": "json_file", "path": str(tmp_path)}}}
    assert sorted(r.a for r in read_source(spark, spec, "x", multiLine=True).collect()) == [1, 2]


def test_file_patterns(spark, tmp_path):
    for name in ("one.csv", "two.csv", "one.txt", "b{1}.csv"):
        (tmp_path / name).write_text(name)
    (tmp_path / "day=1").mkdir()
    (tmp_path / "day=1" / "x.csv").write_text("x")
    spec = {"data_sources": {"x": {"source_type": "csv_file", "path": str(tmp_path)}}}

    def names(pattern):
        return sorted(r[0] for r in read_source(spark, spec, "x", file_pattern=pattern, schema="v string").collect())

    assert names("o*.csv") == ["one.csv"]
    assert names("[!o]wo.???") == ["two.csv"]
    assert names("b{1}.csv") == ["b{1}.csv"]
    inner = read_source(spark, spec, "x", file_pattern="day=*/*.csv", schema="v string")
    assert [tuple(r) for r in inner.collect()] == [("x", 1)]


def test_shell_pattern():
    assert _hadoop_glob("a[!b]{c}*?") == "a[^b]\\{c\\}*?"


@pytest.mark.parametrize("kind", ["sftp_csv", "sftp_parquet"])
def test_empty_drop_folder(spark, tmp_path, kind):
    (tmp_path / "other.dat").mkdir()
    spec = {"data_sources": {"x": {"source_type": kind, "remote_path": str(tmp_path)}}}
    empty = read_source(spark, spec, "x", file_pattern="*.none", schema="a int, b string")
    assert empty.dtypes == [("a", "int"), ("b", "string")] and empty.isEmpty()
    for pattern in ({}, {"file_pattern": "*.none"}):
        with pytest.raises(ValueError, match="state a schema"):
            read_source(spark, spec, "x", **pattern)
    spec["data_sources"]["x"]["remote_path"] = str(tmp_path / "missing")
    for pattern in ({}, {"file_pattern": "*.none"}):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            read_source(spark, spec, "x", schema="a int", **pattern)


def test_single_remote_file_as_text(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n")
    spec = {"data_sources": {"x": {"connection_name": "partner_sftp", "remote_path": str(tmp_path / "a.log")}}}
    assert [r.value for r in read_source(spark, spec, "x").collect()] == ["one", "two"]


def test_required_columns(spark):
    require_columns(spark.range(1), ["id"])
    with pytest.raises(ValueError, match="missing columns: a, b"):
        require_columns(spark.range(1), ["id", "b", "a"])


def test_absent_sources(spark):
    from datetime import date

    spec = {"business_logic": {"active_status_value": "A"}}
    assert active_parties(spark, spec).dtypes == [("msisdn", "string")]
    assert transactions(spark, spec, date(2024, 1, 1), date(2024, 1, 2)).columns[2] == "transaction_date"
    with pytest.raises(ValueError, match="active_status_value"):
        active_parties(spark, {})


def test_active_parties(spark, tmp_path):
    users = [("a", "Actif"), ("b", "ACTIF"), ("c", None), ("d", "OUT"), ("e", "actif ")]
    spark.createDataFrame(users, "user_msisdn string, user_status string").write.parquet(str(tmp_path / "u"))
    spec = {"data_sources": {"users": {"path": str(tmp_path / "u")}}, "business_logic": {"active_status_value": "actif"}}
    assert sorted(r.msisdn for r in active_parties(spark, spec).collect()) == ["a", "b"]
    spec["columns"] = {"users": {"status": "state"}}
    with pytest.raises(ValueError, match="missing columns: state"):
        active_parties(spark, spec)


def test_quoting():
    assert quote_name("a`b", "jdbc:mariadb://h/d") == "`a``b`"
    assert quote_name("a]b", "jdbc:sqlserver://h") == "[a]]b]"
    assert quote_name('a"b', "jdbc:postgresql://h/d") == '"a""b"'
    assert quote_text("it's\\", "jdbc:mysql://h/d") == "'it''s\\\\'"
    assert quote_text("it's\\", "jdbc:derby:memory:x") == "'it''s\\'"


def test_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared) and first != second
    with materialised(spark.range(5), "five") as df:
        files = df.inputFiles()
        assert df.dtypes == [("id", "bigint")] and df.count() == 5
        assert files and all(shared in f for f in files)
    assert not any(Path(f.removeprefix("file://")).exists() for f in files)


def test_partition_column_chooses_the_folders(spark, tmp_path):
    """A feed laid out by day: only the folders of the run's days are scanned."""
    hours = spark.range(24 * 20).selectExpr(
        "'a' p", "'C2S' c", "timestamp'2024-03-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) t"
    )
    hours.selectExpr("*", "date_format(t, 'yyyy-MM-dd') day").write.partitionBy("day").parquet(f"{tmp_path}/tx")
    names = {c: "p" for c in ("sndr_msisdn", "rcvr_msisdn", "sndr_category", "rcvr_category")}
    spec = {
        "data_sources": {"transactions": {"path": f"{tmp_path}/tx", "partition_column": "day"}},
        "columns": {"transactions": {**names, "channel": "c", "date": "t"}},
    }
    for first, rows in ((date(2024, 3, 4), 48), (None, 120)):
        df = transactions(spark, spec, first, date(2024, 3, 5))
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters") :].split("]")[0]
        assert "day" in filters and "2024-03-05" in filters and df.count() == rows
    spec["data_sources"]["transactions"]["partition_column"] = "folder"
    with pytest.raises(ValueError, match="folder"):
        transactions(spark, spec, None, date(2024, 3, 5))


def test_scratch_paths_are_in_one_folder_of_the_session(spark):
    one, two = scratch_path(spark, "a"), scratch_path(spark, "b")
    assert one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0] and spark.sparkContext.applicationId in one
