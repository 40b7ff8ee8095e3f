"""JDBC on Derby inside the Spark process: no server, no port, nothing on disk."""

from datetime import date, datetime, timedelta
from uuid import uuid4

import pytest

from tidemark.sinks import write_output
from tidemark.sources import active_parties, read_source, transactions

TX = (
    "tra_sndr_msisdn string, tra_receiver_msisdn string, tra_date timestamp, "
    "tra_sndr_category string, tra_receiver_category string, tra_channel string, note string"
)


@pytest.fixture
def db():
    """A spec with one empty database and one entry, source and output alike."""
    url = f"jdbc:derby:memory:d{uuid4().hex};create=true"
    entry = {"connection_name": "db", "table": "items", "options_override": {}}
    return {
        "connections": {"db": {"url": url, "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}},
        "data_sources": {"x": {**entry, "db_type": "jdbc"}},
        "outputs": {"x": entry},
    }


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_write_modes_and_options(spark, db):
    numbers = spark.range(10)
    write_output(numbers, db, "x", batchsize=3, isolationLevel="READ_COMMITTED")
    write_output(numbers, db, "x", mode="append")
    assert read_source(spark, db, "x").count() == 20
    write_output(spark.range(4), db, "x", mode="overwrite", truncate=True)
    assert read_source(spark, db, "x", fetchsize=2, queryTimeout=60, sessionInitStatement="VALUES 1").count() == 4
    assert not write_output(spark.range(0), db, "x")
    assert read_source(spark, db, "x").count() == 4


def test_query_runs_in_the_database(spark, db):
    write_output(spark.range(10), db, "x")
    query = 'SELECT "id" * 2 AS "twice" FROM items WHERE "id" > 6'
    doubled = read_source(spark, db, "x", query_string=query, query_alias="q")
    assert sorted(r.twice for r in doubled.collect()) == [14, 16, 18]
    assert read_source(spark, db, "x", query_string=query).count() == 3


def test_table_or_query_is_needed(spark, db):
    del db["data_sources"]["x"]["table"]
    with pytest.raises(ValueError, match="table or a query"):
        read_source(spark, db, "x")


@pytest.mark.parametrize("kind", ["bigint", "decimal(12,2)", "date", "timestamp"])
def test_split_scan_finds_its_bounds(spark, db, kind):
    if kind in ("date", "timestamp"):
        df = spark.range(100).selectExpr(f"cast(date_add(date'2024-01-01', cast(id as int)) as {kind}) k", "id")
    else:
        df = spark.range(100).selectExpr(f"cast(id - 50.5 as {kind}) k", "id")
    df = df.unionByName(df.limit(1).selectExpr("cast(null as " + kind + ") k", "id"))
    write_output(df, db, "x")
    split = read_source(spark, db, "x", partitionColumn="k", numPartitions=4)
    assert split.rdd.getNumPartitions() == 4
    assert split.count() == 101 and split.exceptAll(df).isEmpty()
    sizes = split.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes) < 40


def test_split_scan_of_an_empty_table(spark, db):
    write_output(spark.range(0), db, "x", skip_empty=False)
    assert read_source(spark, db, "x", partitionColumn="id", numPartitions=4).count() == 0


def test_given_bounds_only_place_the_splits(spark, db):
    write_output(spark.range(100), db, "x")
    bounds = {"partitionColumn": "id", "numPartitions": 3, "lowerBound": 10, "upperBound": 20}
    assert read_source(spark, db, "x", **bounds).count() == 100


def test_job_may_not_redirect_a_connection(spark, db):
    write_output(spark.range(3), db, "x")
    db["data_sources"]["x"]["options_override"] = {"url": "jdbc:derby:memory:other", "driver": "none", "dbtable": "y"}
    assert read_source(spark, db, "x").count() == 3


def test_days_are_filtered_and_split_in_the_database(spark, db):
    start = datetime(2024, 3, 1)
    rows = [("a", "b", start + timedelta(hours=i), "A", "B", "C2S", "-") for i in range(24 * 10)]
    df = spark.createDataFrame(rows, TX)
    types = ", ".join(f"{c} VARCHAR(20)" for c, t in df.dtypes if t == "string")
    write_output(df, db, "x", createTableColumnTypes=types)
    db["data_sources"]["x"]["options_override"] = {"partitionColumn": "tra_date", "numPartitions": 4}
    got = transactions(spark, db, date(2024, 3, 4), date(2024, 3, 5), "x")
    assert got.count() == 48 and got.columns[2] == "transaction_date" and len(got.columns) == 6
    sizes = got.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert max(sizes) <= 13
    text = plan(got)
    assert "tra_date\" >= {ts '2024-03-04 00:00:00'}" in text and "note" not in text


def test_days_do_not_depend_on_the_session_time_zone(spark, db):
    hour = "timestamp_ntz'2024-03-04 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) t"
    hours = spark.range(72).selectExpr(hour, "'a' p")
    write_output(hours, db, "x", createTableColumnTypes="p VARCHAR(9)")
    names = {c: "p" for c in ("sndr_msisdn", "rcvr_msisdn", "sndr_category", "rcvr_category", "channel")}
    db["columns"] = {"x": {"date": "t", **names}}
    for zone in ("Asia/Tokyo", "America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        for ntz in (True, False):
            db["data_sources"]["x"]["options_override"] = {"preferTimestampNTZ": ntz}
            assert transactions(spark, db, date(2024, 3, 5), date(2024, 3, 5), "x").count() == 24


def test_users_are_filtered_in_the_database_and_split(spark, db):
    users = spark.range(100).selectExpr("id", "cast(id as string) who", "if(id % 4 = 0, 'Actif', 'OUT') state")
    write_output(users, db, "x", createTableColumnTypes="who VARCHAR(9), state VARCHAR(9)")
    db["business_logic"] = {"active_status_value": "ACTIF"}
    db["columns"] = {"x": {"msisdn": "who", "status": "state"}}
    db["data_sources"]["x"]["options_override"] = {"partitionColumn": "id", "numPartitions": 3}
    active = active_parties(spark, db, "x")
    assert active.columns == ["msisdn"] and active.rdd.getNumPartitions() == 3
    assert sorted(int(r.msisdn) for r in active.collect()) == list(range(0, 100, 4))


def test_transactions_are_split_by_their_days_unless_told_otherwise(spark, db):
    start = datetime(2024, 3, 1)
    rows = [("a", "b", start + timedelta(hours=i), "A", "B", "C2S", "-") for i in range(24 * 10)]
    df = spark.createDataFrame(rows, TX)
    types = ", ".join(f"{c} VARCHAR(20)" for c, t in df.dtypes if t == "string")
    write_output(df, db, "x", createTableColumnTypes=types)
    read = lambda first=date(2024, 3, 4): transactions(spark, db, first, date(2024, 3, 7), "x")
    got = read()
    assert got.count() == 96 and got.rdd.getNumPartitions() == 8
    sizes = got.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert max(sizes) <= 13
    assert read(None).count() == 7 * 24
    for given, parts in (
        ({"numPartitions": 1}, 1),
        ({"NUMPARTITIONS": 3}, 3),
        ({"partitioncolumn": "tra_date", "numPartitions": 4, "lowerBound": "1990-01-01", "upperbound": "2090-01-01"}, 4),
    ):
        db["data_sources"]["x"]["options_override"] = given
        got = read()
        assert got.count() == 96 and got.rdd.getNumPartitions() == parts
        assert max(got.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()) <= 96 // parts + 1
