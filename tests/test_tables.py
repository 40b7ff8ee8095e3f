from uuid import uuid4

import pytest

from tests.test_late import rows as transactions_of
from tidemark.names import PARTY
from tidemark.operators import latest_event, party_events
from tidemark.sinks import write_output
from tidemark.sources import read_source


def spec_of(tmp_path, **more):
    table = f"t_{uuid4().hex}"
    place = {"output_type": "catalog_table", "table": table, "options_override": {"path": f"{tmp_path}/{table}"}, **more}
    return {"outputs": {"t": place}, "data_sources": {"t": {"source_type": "catalog_table", "table": table}}}


def bucketed(spark, tmp_path, df):
    spec = spec_of(tmp_path, bucket_by=PARTY, buckets=5)
    assert write_output(df, spec, "t")
    return read_source(spark, spec, "t")


def feed_and_list(spark):
    schema = "sender_msisdn string, receiver_msisdn string, transaction_date timestamp, sender_category string, receiver_category string, channel string"
    events = party_events(spark.createDataFrame(transactions_of(1, 400), schema))
    return events, events.select(PARTY).distinct().where(f"length({PARTY}) < 3")


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]


def test_join_and_ranking_need_no_exchange(spark, tmp_path):
    events, active = feed_and_list(spark)
    kept = [bucketed(spark, tmp_path, df) for df in (events, active)]
    found = latest_event(*kept, broadcast=False)
    plan = plan_of(found)
    assert "Exchange" not in plan and "SelectedBucketsCount: 5 out of 5" in plan
    plain = latest_event(events, active, broadcast=False)
    assert "Exchange" in plan_of(plain)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect())) != []


def test_a_bucket_is_one_file_and_modes_hold(spark, tmp_path):
    spec = spec_of(tmp_path, bucket_by=["id"], buckets=3, sort_by="v")
    df = spark.range(1000).selectExpr("id", "-id v")
    write_output(df, spec, "t")
    files = list((tmp_path / spec["outputs"]["t"]["table"]).glob("*.parquet"))
    assert len(files) == 3
    write_output(df.limit(10), spec, "t")  # replaces
    assert read_source(spark, spec, "t").count() == 10
    write_output(df.limit(5), spec, "t", mode="append")
    assert read_source(spark, spec, "t").count() == 15
    assert not write_output(df.limit(0), spec, "t") and read_source(spark, spec, "t").count() == 15


def test_plain_table_and_refusals(spark, tmp_path):
    spec = spec_of(tmp_path)
    write_output(spark.range(7), spec, "t")
    assert read_source(spark, spec, "t").count() == 7
    with pytest.raises(ValueError, match="number of buckets"):
        write_output(spark.range(7), spec_of(tmp_path, bucket_by="id"), "t")
    nameless = {kind: {"t": {f"{word}_type": "catalog_table"}} for kind, word in (("outputs", "output"), ("data_sources", "source"))}
    with pytest.raises(ValueError, match="no table"):
        write_output(spark.range(1), nameless, "t")
    with pytest.raises(ValueError, match="no table"):
        read_source(spark, nameless, "t")
