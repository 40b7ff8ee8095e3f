import pytest
from pyspark.errors import AnalysisException

from tidemark.sinks import output_type, write_output


@pytest.mark.parametrize(
    "entry, expected",
    [
        ({"output_type": "ORC_file", "table": "t", "connection_name": "c"}, "orc_file"),
        ({"table": "t", "connection_name": "c"}, "jdbc_table"),
        ({"collection": "t", "connection_name": "c"}, "mongo_collection"),
        ({"path": "/x"}, "parquet_file"),
        ({"connection_name": "my_SFTP"}, "sftp_file"),
    ],
)
def test_output_type(entry, expected):
    assert output_type(entry) == expected


def test_unclear_output():
    with pytest.raises(ValueError):
        output_type({"table": "t"})


def spec_of(path, **entry):
    return {"outputs": {"x": {"path": str(path), **entry}}}


def test_mode_order_and_wrong_mode(spark, tmp_path):
    spec, df = spec_of(tmp_path / "o", mode="append"), spark.range(3)
    assert write_output(df, spec, "x")
    assert write_output(df, spec, "x")
    assert spark.read.parquet(str(tmp_path / "o")).count() == 6
    write_output(df, spec, "x", mode="overwrite")
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3
    with pytest.raises(AnalysisException):
        write_output(df, spec, "x", mode="error")
    with pytest.raises(ValueError, match="replace"):
        write_output(df, spec, "x", mode="replace")
    with pytest.raises(ValueError, match="not defined"):
        write_output(df, spec, "y")


def test_nothing_to_write_leaves_the_target_alone(spark, tmp_path):
    spec = spec_of(tmp_path / "o")
    assert not write_output(None, spec, "x")
    assert not write_output(spark.range(0), spec, "x")
    assert not (tmp_path / "o").exists()
    write_output(spark.range(3), spec, "x")
    assert not write_output(spark.range(0), spec, "x")
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3


@pytest.mark.parametrize("columns", ["day", ["day"]])
def test_partitions_are_replaced_one_by_one(spark, tmp_path, columns):
    spec = spec_of(tmp_path / "o", partition_by=columns)
    write_output(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, day string"), spec, "x")
    write_output(spark.createDataFrame([(3, "2024-01-02")], "v int, day string"), spec, "x")
    back = spark.read.schema("v int, day string").parquet(str(tmp_path / "o"))
    assert sorted(map(tuple, back.collect())) == [(1, "2024-01-01"), (3, "2024-01-02")]
    assert (tmp_path / "o" / "day=2024-01-02").is_dir()
    write_output(back.limit(1), spec_of(tmp_path / "p", partition_by=columns), "x")
    spec["outputs"]["x"]["options_override"] = {"partitionOverwriteMode": "static"}
    write_output(spark.createDataFrame([(4, "2024-01-03")], "v int, day string"), spec, "x")
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1


def test_partitions_become_few_files(spark, tmp_path):
    """64 tasks and 4 days: without the rebalance this would be 256 files."""
    df = spark.range(0, 20_000, 1, 64).selectExpr("id", "cast(id % 4 as string) day")
    write_output(df, spec_of(tmp_path / "o", partition_by="day"), "x")
    assert len(list((tmp_path / "o").rglob("*.parquet"))) == 4
    assert spark.read.parquet(str(tmp_path / "o")).count() == 20_000


def test_heavy_partition_is_split(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 64).selectExpr("id", "'2024-01-01' day")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32KB")
    try:
        write_output(df, spec_of(tmp_path / "o", partition_by="day"), "x")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert 2 < len(list((tmp_path / "o").rglob("*.parquet"))) < 64


def test_text_holds_one_string_column(spark, tmp_path):
    spec = spec_of(tmp_path / "o", output_type="text_file")
    write_output(spark.createDataFrame([("a",), ("b",)], "v string"), spec, "x")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "o")).collect()) == ["a", "b"]
    for wrong in (spark.range(1), spark.createDataFrame([("a", "b")], "v string, w string")):
        with pytest.raises(ValueError, match="one string column"):
            write_output(wrong, spec, "x", mode="overwrite")
    by_day = spec_of(tmp_path / "p", output_type="text_file", partition_by="day")
    write_output(spark.createDataFrame([("a", 1)], "v string, day int"), by_day, "x")
    assert (tmp_path / "p" / "day=1").is_dir()


def test_file_options(spark, tmp_path):
    options = {"sep": "|", "header": True, "compression": "gzip", "maxRecordsPerFile": 2}
    spec = spec_of(tmp_path / "o", output_type="csv_file", options_override=options)
    write_output(spark.range(4).coalesce(1), spec, "x", encoding=None)
    assert len(list((tmp_path / "o").glob("*.csv.gz"))) == 2


def test_drop_folder_collects_files(spark, tmp_path):
    spec = {"outputs": {"x": {"output_type": "sftp_csv", "remote_base_path": str(tmp_path / "drop")}}}
    write_output(spark.range(2), spec, "x")
    write_output(spark.range(3), spec, "x")
    assert spark.read.csv(str(tmp_path / "drop")).count() == 5


def test_missing_target(spark):
    with pytest.raises(ValueError, match="no path"):
        write_output(spark.range(1), {"outputs": {"x": {"output_type": "csv_file"}}}, "x")
    with pytest.raises(NotImplementedError):
        write_output(spark.range(1), {"outputs": {"x": {"output_type": "xml_file"}}}, "x")


def test_file_names_cannot_be_chosen(spark, tmp_path):
    place = {"output_type": "sftp_csv", "remote_base_path": str(tmp_path / "drop")}
    for entry, more in (({**place, "output_filename_pattern": "day"}, {}), (place, {"output_filename_pattern": "day"})):
        with pytest.raises(ValueError, match="output_filename_pattern"):
            write_output(spark.range(3), {"outputs": {"x": entry}}, "x", **more)
    assert not (tmp_path / "drop").exists()
