"""

The tables have no two-party transactions, so `lineitem` and its order, supplier and customer stand
in for them: the supplier sends, the customer receives, and the return flag is the channel. The
`events` table is the daily feed, with one party per row.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date, timedelta
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import has_party
from tidemark.names import CATEGORY, DONE, JOB, OUT_DAY, PARTY, TIME
from tidemark.operators import (
    StageCounts,
    advance_state,
    apply_difference,
    asof_join,
    catchup_days,
    daily_sketches,
    daily_snapshots,
    each_day,
    interval_join,
    latest_event,
    merge_sketches,
    moving_totals,
    only_parties,
    party_events,
    rank_events,
    sessions,
    snapshot_difference,
    totals_by,
    union_events,
    validity,
    whole_plans,
)
from tidemark.plans import (
    append_progress,
    calculate_last_transaction,
    create_progress,
    last_done,
    read_progress,
    read_sessions,
    repair_job,
    run_job,
    run_sessions,
    run_stream,
    shape_output,
)
from tidemark.sinks import write_output
from tidemark.sources import active_parties, read_source, select_mapped, transactions
from tidemark.storage import scratch_path

# The text operators are a subpackage of their own; everything else works without it.
try:
    import tidemark.llm.queries as text_queries
except ImportError as missing:  # the subpackage, or a library that only it needs
    logging.getLogger(__name__).warning("text queries are left out: %s", missing)
    text_queries = None

# Channels of the stand-in transactions, and of the feed when the job reads it as transactions.
FLAGS = {"channel_c2s": "a", "channel_o2c": "n", "channel_c2c": "r"}
FEED_KINDS = {"channel_c2s": "click", "channel_o2c": "view", "channel_c2c": "purchase"}
RULES = {"A": ["sender"], "N": ["receiver"], "R": ["sender", "receiver"]}
AS_OF = date(2024, 1, 31)  # the feed covers January 2024


def entry(spark: SparkSession) -> DataFrame:
    return last_transaction(spark, "/root/testdata/sf0.001")


# --- inputs -------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stand_in_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers are joined to orders before the line items, so the large table is joined twice, not three times."""
    buyers = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    items = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    return items.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").cast("string").alias("sender_msisdn"),
        F.col("o_custkey").cast("string").alias("receiver_msisdn"),
        F.col("l_shipdate").alias("transaction_date"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("sender_category"),
        F.col("c_mktsegment").alias("receiver_category"),
        F.col("l_returnflag").alias("channel"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias(CATEGORY), F.col("ts").alias(TIME), F.col("user_id").cast("string").alias(PARTY)
    )


def job_spec(sf_dir: str, **more) -> dict:
    """The job on the given tables: customers are the users, the feed the transactions."""
    return {
        "data_sources": {
            "users": {"path": f"{sf_dir}/customer.parquet"},
            "transactions": {"path": f"{sf_dir}/events.parquet"},
        },
        "columns": {
            "users": {"msisdn": "c_custkey", "status": "c_mktsegment"},
            "transactions": {
                "sndr_msisdn": "user_id",
                "rcvr_msisdn": "user_id",
                "date": "ts",
                "sndr_category": "event_type",
                "rcvr_category": "event_type",
                "channel": "event_type",
            },
        },
        "business_logic": {"active_status_value": "building", **FEED_KINDS},
        **more,
    }


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return party_events(stand_in_transactions(spark, sf_dir), RULES)


def active_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_parties(spark, job_spec(sf_dir))


# --- the job ------------------------------------------------------------------


def last_transaction(spark, sf_dir):
    spec = {"business_logic": FLAGS}
    return calculate_last_transaction(active_of(spark, sf_dir), stand_in_transactions(spark, sf_dir), spec)


def output_columns(spark, sf_dir):
    return shape_output(last_transaction(spark, sf_dir), job_spec(sf_dir), AS_OF)


def job_days_run(spark, sf_dir):
    """`initial` up to the 10th, then `catchup`: the carried state must reach every later day."""
    spec = _job_outputs(spark, job_spec(sf_dir))
    run_job(spark, spec, "initial", AS_OF, start="2024-01-01", end="2024-01-10")
    run_job(spark, spec, "catchup", AS_OF)
    return _published(spark, spec)


def job_range_run(spark, sf_dir):
    spec = _job_outputs(spark, job_spec(sf_dir))
    run_job(spark, spec, "initial", AS_OF, start="2024-01-05", end="2024-01-20", carry=False)
    return _published(spark, spec)


def job_resumed_run(spark, sf_dir):
    """Runs that start in the middle of the feed with no kept state: their days still go back to its begin."""
    one, other = (_job_outputs(spark, job_spec(sf_dir)) for _ in range(2))
    run_job(spark, one, "specific_date", AS_OF, day="2024-01-20")
    run_job(spark, other, "daily", AS_OF)
    return _published(spark, one).unionByName(_published(spark, other))


def job_rerun(spark, sf_dir):
    """Six days, then the same again on a feed that lost its first three: those days must be gone."""
    spec = _job_outputs(spark, job_spec(sf_dir))
    run_job(spark, spec, "initial", AS_OF, start="2024-01-01", end="2024-01-06")
    reduced = scratch_path(spark, "reduced")
    table(spark, sf_dir, "events").where(F.col("ts") >= F.lit(date(2024, 1, 4))).write.parquet(reduced)
    spec["data_sources"] = {**spec["data_sources"], "transactions": {"path": reduced}}
    run_job(spark, spec, "initial", AS_OF, start="2024-01-01", end="2024-01-06")
    return _published(spark, spec)


def late_repair(spark, sf_dir):
    """The whole month without the purchases of its first ten days, which then arrive late: as if they had been in time."""
    late = (F.col("event_type") == "purchase") & (F.col("ts") < F.lit(date(2024, 1, 11)))
    events, on_time = table(spark, sf_dir, "events"), scratch_path(spark, "on_time")
    events.where(~late).write.parquet(on_time)
    spec = _job_outputs(spark, job_spec(sf_dir))
    feed_of = spec["data_sources"]["transactions"]
    spec["data_sources"] = {**spec["data_sources"], "transactions": {"path": on_time}}
    run_job(spark, spec, "initial", AS_OF, start="2024-01-01", end="2024-01-30")
    after = {**spec, "data_sources": {**spec["data_sources"], "transactions": feed_of}}
    arrived = transactions(spark, after, date(2024, 1, 1), date(2024, 1, 10)).where(F.col("channel") == "purchase")
    repair_job(spark, spec, arrived)
    return _published(spark, spec)


def job_streamed(spark, sf_dir):
    """The feed as six files of mixed days, two to a batch: pictures as those of the job over all of it."""
    folder = scratch_path(spark, "arriving")
    table(spark, sf_dir, "events").repartition(6, "event_id").write.parquet(folder)
    spec = _job_outputs(spark, job_spec(sf_dir))
    spec["data_sources"] = {**spec["data_sources"], "transactions": {"path": folder}}
    spec["outputs"]["increments"] = {"path": scratch_path(spark, "increments")}
    run_stream(spark, spec, AS_OF, files_per_batch=2)
    return _published(spark, spec)


def _job_outputs(spark, spec):
    root = scratch_path(spark, "job")
    return {
        **spec,
        "outputs": {
            "last_transaction_output": {"path": f"{root}/published", "partition_by": ["day"]},
            "state": {"path": f"{root}/state"},
        },
        "metadata": {"tracker_path": f"{root}/progress", "job_name_identifier": "last_transaction"},
    }


def _published(spark, spec):
    path = spec["outputs"]["last_transaction_output"]["path"]
    return spark.read.parquet(path).withColumn(OUT_DAY, F.col(OUT_DAY).cast("string"))


# --- rows ---------------------------------------------------------------------


def column_mapping(spark, sf_dir):
    columns = {"msisdn": "c_custkey", "status": "c_mktsegment", "category": "c_nationkey"}
    return select_mapped(table(spark, sf_dir, "customer"), columns)


def date_range_filter(spark, sf_dir):
    return transactions(spark, job_spec(sf_dir), date(2024, 1, 5), date(2024, 1, 12))


def channel_filter(spark, sf_dir):
    return party_events(stand_in_transactions(spark, sf_dir), {"a": ["sender"]})


def valid_party_filter(spark, sf_dir):
    value = F.col("value")
    party = F.when(value < 5, None).when(value < 10, "").when(value < 15, " ").otherwise(F.col("event_type"))
    rows = table(spark, sf_dir, "events").select("event_id", party.alias("party"))
    return rows.where(has_party("party"))


def active_party_events(spark, sf_dir):
    return only_parties(events_of(spark, sf_dir), active_of(spark, sf_dir))


def events_union(spark, sf_dir):
    return union_events(events_of(spark, sf_dir), feed(spark, sf_dir))


def ranked_events(spark, sf_dir):
    return rank_events(events_of(spark, sf_dir))


def last_click_before(spark, sf_dir):
    """For every event its user's last click up to then, itself if it is one."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    clicks = table(spark, sf_dir, "events").where("event_type = 'click'")
    clicks = clicks.select("user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"), "value")
    found = asof_join(events, clicks.withColumn("clicked", F.col("click_ts")), "user_id", "ts", ["click_id", "value", "clicked"], right_time="click_ts")
    return found.select("event_id", "user_id", "ts", "click_id", "clicked", F.col("value").alias("click_value"))


def purchase_held(spark, sf_dir):
    """Every event with its user's purchase that counted on its day."""
    events = feed(spark, sf_dir).select(PARTY, F.col(TIME).alias("ts"), F.col(CATEGORY).alias("kind"))
    spans = validity(feed(spark, sf_dir).where(F.col(CATEGORY) == "purchase"))
    spans = spans.select(PARTY, F.col(TIME).alias("purchased"), "valid_from", F.date_add("valid_to", 1).alias("until"))
    return interval_join(events, spans, PARTY, "ts", "valid_from", "until", ["purchased", "valid_from"])


def snapshot_changes(spark, sf_dir):
    """What the pictures of the 10th and the 20th differ in."""
    return snapshot_difference(*_two_pictures(spark, sf_dir))


def snapshot_applied(spark, sf_dir):
    """The picture of the 20th, from that of the 10th and the differences."""
    early, late = _two_pictures(spark, sf_dir)
    return apply_difference(early, snapshot_difference(early, late))


def _two_pictures(spark, sf_dir):
    events = feed(spark, sf_dir)
    return [daily_snapshots(events, day, day).drop("day") for day in (date(2024, 1, 10), date(2024, 1, 20))]


def transaction_totals(spark, sf_dir):
    """Transactions by channel, category and day, by two of these, by one, and in all."""
    sent = stand_in_transactions(spark, sf_dir).withColumn("sent", F.to_date("transaction_date"))
    sent = sent.select(F.col("channel"), F.col("sender_category").alias("category"), "sent")
    sets = [["channel", "category", "sent"], ["channel", "category"], ["channel", "sent"], ["category"], []]
    return totals_by(sent, sets, {"n": ("count", "*"), "first_day": ("min", "sent"), "last_day": ("max", "sent")})


def moving_week(spark, sf_dir):
    """Events of every user and day with those of the six days before."""
    events = table(spark, sf_dir, "events").withColumn("cents", F.floor(F.col("value") * 100))
    measures = {"n": ("count", "*"), "cents": ("sum", "cents"), "largest": ("max", "value")}
    return moving_totals(events, "user_id", "ts", measures)


def merged_sketches(spark, sf_dir):
    """Users and percentiles of values from the 8th to the 21st, from rows kept per day and kind: by kind, and in all.

    Exact here, as a day has fewer users and values of a kind than a row lists; beyond that the operator estimates.
    """
    kept = scratch_path(spark, "sketches")
    daily_sketches(table(spark, sf_dir, "events"), ["event_type"], "ts", "user_id", "value").write.parquet(kept)
    days = {"first": date(2024, 1, 8), "last": date(2024, 1, 21)}
    by_kind, whole = (merge_sketches(spark.read.parquet(kept), by, [50, 90, 99], **days) for by in (["event_type"], []))
    return by_kind.unionByName(whole, allowMissingColumns=True)


def user_sessions(spark, sf_dir):
    return sessions(table(spark, sf_dir, "events"), "user_id", "ts", gap_seconds=6 * 3600)


def sessions_streamed(spark, sf_dir):
    """Sessions of the streamed feed that end before the watermark, three days before its last event; a purchase counts for both sides."""
    folder = scratch_path(spark, "arriving")
    table(spark, sf_dir, "events").write.parquet(folder)
    spec = {**job_spec(sf_dir), "outputs": {"sessions": {"path": scratch_path(spark, "sessions")}}}
    spec["data_sources"] = {**spec["data_sources"], "transactions": {"path": folder}}
    run_sessions(spark, spec, gap_seconds=6 * 3600, late_seconds=3 * 86_400)
    return read_sessions(spark, spec)


def bucketed_latest(spark, sf_dir):
    """Latest events of active parties, both kept as catalog tables bucketed by party."""
    spec = {"outputs": {}, "data_sources": {}}
    for name, rows in (("events", feed(spark, sf_dir)), ("active", active_of(spark, sf_dir))):
        place = {"table": f"{name}_{uuid4().hex}", "bucket_by": PARTY, "buckets": 8}
        place["options_override"] = {"path": scratch_path(spark, name)}
        spec["outputs"][name] = {**place, "output_type": "catalog_table"}
        spec["data_sources"][name] = {"table": place["table"], "source_type": "catalog_table"}
        write_output(rows, spec, name)
    return latest_event(read_source(spark, spec, "events"), read_source(spark, spec, "active"))


def load_metrics(spark, sf_dir):
    """Rows per stage, observed while the flagship runs once; one stage turns out empty."""
    count = StageCounts()
    active = count("active users", active_of(spark, sf_dir))
    events = party_events(count("transactions", stand_in_transactions(spark, sf_dir)), RULES)
    found = count("result", latest_event(count("events", events), active))
    nobody = only_parties(count("unlisted", found.where(F.col(PARTY) == "")), active)
    with whole_plans(spark):
        found.unionByName(nobody).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(count.result().items()), "stage string, row_count long")


# --- days ---------------------------------------------------------------------


def snapshots(spark, sf_dir):
    return daily_snapshots(feed(spark, sf_dir), date(2024, 1, 1), AS_OF - timedelta(days=1))


def state_advanced(spark, sf_dir):
    events, split = feed(spark, sf_dir), date(2024, 1, 16)
    before = latest_event(events.where(F.col(TIME) < F.lit(split)))
    return advance_state(before, events, split, AS_OF)


def calendar_range(spark, sf_dir):
    """Days between each user's first and last event; swapped bounds must give none."""
    seen = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    forward = each_day(seen, F.col("lo"), F.col("hi"))
    backward = each_day(seen, F.col("hi"), F.date_sub(F.col("lo"), 1))
    return forward.unionByName(backward).select("user_id", "day")


def catchup_calendar(spark, sf_dir):
    """Every customer is a job, done up to its last event; most have none."""
    done = table(spark, sf_dir, "events").groupBy("user_id").agg(F.to_date(F.max("ts")).alias("done"))
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    jobs = customers.join(done, F.col("c_custkey") == F.col("user_id"), "left")
    owed = catchup_days(jobs, F.col("done"), F.lit(AS_OF - timedelta(days=1)))
    return owed.select(F.col("c_custkey").alias("job"), "day")


def watermark_upsert(spark, sf_dir):
    """Every user is a job: progress to its last day, then a rerun of its first day."""
    spec = _progress(spark, "any")
    day = F.to_date("ts")
    jobs = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias(JOB))
    append_progress(jobs.agg(F.max(day).alias(DONE)), spec)
    append_progress(jobs.agg(F.min(day).alias(DONE)), spec)
    return read_progress(spark, spec).select(JOB, DONE)


def watermark_read(spark, sf_dir):
    spec = _progress(spark, "purchase")
    days = table(spark, sf_dir, "events").select(F.col("event_type").alias(JOB), F.to_date("ts").alias(DONE))
    append_progress(days.distinct(), spec)
    row = read_progress(spark, spec).where(F.col(JOB) == "purchase")
    return row.select(JOB, DONE, F.lit(last_done(spark, spec)).alias("reached"))


def _progress(spark, job):
    spec = {"metadata": {"tracker_path": scratch_path(spark, "progress"), "job_name_identifier": job}}
    create_progress(spark, spec)
    return spec


# --- files --------------------------------------------------------------------


def parquet_read(spark, sf_dir):
    spec = {"data_sources": {"orders": {"path": f"{sf_dir}/orders.parquet", "format": "parquet"}}}
    return read_source(spark, spec, "orders")


def file_pattern_read(spark, sf_dir):
    spec = {"data_sources": {"any": {"source_type": "parquet_file", "path": sf_dir}}}
    return read_source(spark, spec, "any", file_pattern="cust*.parquet")


def landing_dir_read(spark, sf_dir):
    spec = {"data_sources": {"drop": {"connection_name": "partner_sftp", "source_type": "sftp_parquet"}}}
    return read_source(spark, spec, "drop", remote_path=sf_dir, file_pattern="line[!x]tem.parquet")


def landing_dir_write(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    folder = scratch_path(spark, "landing")
    spec = {
        "outputs": {"drop": {"output_type": "sftp_csv", "remote_base_path": folder}},
        "data_sources": {"drop": {"source_type": "sftp_csv", "remote_path": folder}},
    }
    write_output(df, spec, "drop", header=True)
    return read_source(spark, spec, "drop", header=True, schema=df.schema, file_pattern="part-*")


def round_trip(spark, df, kind, read=None, **options):
    """Written and read back by logical name."""
    place = {"path": scratch_path(spark, kind), "options_override": options}
    spec = {
        "outputs": {"x": {"output_type": f"{kind}_file", **place}},
        "data_sources": {"x": {"source_type": f"{kind}_file", **place}},
    }
    write_output(df, spec, "x")
    return read_source(spark, spec, "x", schema=df.schema, **(read or {}))


def parquet_write(spark, sf_dir):
    return round_trip(spark, table(spark, sf_dir, "lineitem"), "parquet", compression="snappy")


def csv_roundtrip(spark, sf_dir):
    time_format = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    df = table(spark, sf_dir, "events")
    return round_trip(spark, df, "csv", header=True, sep=";", encoding="UTF-8", timestampNTZFormat=time_format)


def json_roundtrip(spark, sf_dir):
    return round_trip(spark, table(spark, sf_dir, "conversations"), "json", encoding="UTF-8")


def orc_roundtrip(spark, sf_dir):
    return round_trip(spark, table(spark, sf_dir, "orders"), "orc", compression="zlib")


def text_roundtrip(spark, sf_dir):
    """Text files hold one string per line: each document as a JSON line, whole."""
    df = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "text")
    spec = {"outputs": {"x": {"output_type": "text_file", "path": path}}}
    write_output(df.select(F.to_json(F.struct("*")).alias("value")), spec, "x")
    parsed = F.from_json("value", df.schema).alias("row")
    return spark.read.text(path).select(parsed).select("row.*")


def partitioned_write(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    spec = _by_day(spark)
    write_output(df, spec, "x")
    return read_source(spark, spec, "x", schema=df.schema)


def partition_overwrite(spark, sf_dir):
    """All days, then one of them again with other values: the other days stay."""
    df = table(spark, sf_dir, "events").select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    spec = _by_day(spark)
    write_output(df, spec, "x")
    write_output(df.where("day = '2024-01-10'").withColumn("value", -F.col("value")), spec, "x")
    return read_source(spark, spec, "x", schema=df.schema)


def _by_day(spark):
    place = {"path": scratch_path(spark, "by_day"), "partition_by": ["day"]}
    return {"outputs": {"x": place}, "data_sources": {"x": place}}


def write_modes(spark, sf_dir):
    """Overwrite twice, append, ignore, errorifexists: every key must be there exactly twice."""
    df = table(spark, sf_dir, "orders").select("o_orderkey")
    place = {"path": scratch_path(spark, "modes")}
    spec = {"outputs": {"x": place}, "data_sources": {"x": place}}
    for mode in ("overwrite", "overwrite", "append", "ignore"):
        write_output(df, spec, "x", mode=mode)
    try:
        write_output(df, spec, "x", mode="errorifexists")
        raise AssertionError("errorifexists wrote to an existing path")
    except AnalysisException:
        pass
    return read_source(spark, spec, "x").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("copies"))


# --- JDBC: an embedded database, which only a session in one process can see ---


def database(**tables) -> dict:
    url = f"jdbc:derby:memory:t{uuid4().hex};create=true"
    connections = {"db": {"url": url, "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}}
    entries = {name: {"connection_name": "db", "db_type": "jdbc", "table": name, **e} for name, e in tables.items()}
    return {"connections": connections, "data_sources": entries, "outputs": entries}


def _strings(df):
    return ", ".join(f"{name} VARCHAR(200)" for name, kind in df.dtypes if kind == "string")


def loaded(df, name, **options) -> dict:
    spec = database(**{name: {"options_override": options}})
    write_output(df, spec, name, mode="overwrite", createTableColumnTypes=_strings(df))
    return spec


def jdbc_table_read(spark, sf_dir):
    return read_source(spark, loaded(table(spark, sf_dir, "customer"), "customer"), "customer", fetchsize=1000)


def jdbc_query_read(spark, sf_dir):
    spec = {**job_spec(sf_dir), **loaded(table(spark, sf_dir, "customer"), "users")}
    return active_parties(spark, spec)


def jdbc_partitioned_read(spark, sf_dir):
    spec = loaded(table(spark, sf_dir, "orders"), "orders", fetchsize=1000)
    split = {"partitionColumn": "o_orderkey", "numPartitions": 4}
    return read_source(spark, spec, "orders", preferTimestampNTZ=True, **split)


def jdbc_date_range(spark, sf_dir):
    """The database filters the days and selects the columns; the scan is split within those days."""
    spec = {**job_spec(sf_dir), **loaded(table(spark, sf_dir, "events"), "transactions")}
    split = {"partitionColumn": "event_id", "numPartitions": 4}
    spec["data_sources"]["transactions"]["options_override"] = {"preferTimestampNTZ": True, **split}
    return transactions(spark, spec, date(2024, 1, 5), date(2024, 1, 12))


def jdbc_write(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    spec = loaded(df, "orders", batchsize=1000)
    write_output(df, spec, "orders", mode="append")
    return read_source(spark, spec, "orders")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return own_queries() | (text_queries.queries() if text_queries else {})


def oracle_sql() -> dict[str, str]:
    return own_oracle_sql() | (text_queries.oracle_sql() if text_queries else {})


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "last_transaction": last_transaction,
        "output_columns": output_columns,
        "job_days_run": job_days_run,
        "late_repair": late_repair,
        "last_click_before": last_click_before,
        "purchase_held": purchase_held,
        "snapshot_changes": snapshot_changes,
        "snapshot_applied": snapshot_applied,
        "job_streamed": job_streamed,
        "transaction_totals": transaction_totals,
        "moving_week": moving_week,
        "merged_sketches": merged_sketches,
        "user_sessions": user_sessions,
        "sessions_streamed": sessions_streamed,
        "bucketed_latest": bucketed_latest,
        "job_range_run": job_range_run,
        "job_resumed_run": job_resumed_run,
        "job_rerun": job_rerun,
        "party_events": events_of,
        "channel_filter": channel_filter,
        "valid_party_filter": valid_party_filter,
        "events_union": events_union,
        "active_filter": active_of,
        "active_party_events": active_party_events,
        "column_mapping": column_mapping,
        "date_range_filter": date_range_filter,
        "ranked_events": ranked_events,
        "latest_event": lambda spark, sf_dir: latest_event(events_of(spark, sf_dir)),
        "load_metrics": load_metrics,
        "daily_snapshots": snapshots,
        "advance_state": state_advanced,
        "calendar_range": calendar_range,
        "catchup_calendar": catchup_calendar,
        "watermark_upsert": watermark_upsert,
        "watermark_read": watermark_read,
        "parquet_read": parquet_read,
        "file_pattern_read": file_pattern_read,
        "landing_dir_read": landing_dir_read,
        "landing_dir_write": landing_dir_write,
        "parquet_write": parquet_write,
        "csv_roundtrip": csv_roundtrip,
        "json_roundtrip": json_roundtrip,
        "orc_roundtrip": orc_roundtrip,
        "text_roundtrip": text_roundtrip,
        "partitioned_write": partitioned_write,
        "partition_overwrite": partition_overwrite,
        "write_modes": write_modes,
        "jdbc_table_read": jdbc_table_read,
        "jdbc_query_read": jdbc_query_read,
        "jdbc_partitioned_read": jdbc_partitioned_read,
        "jdbc_date_range": jdbc_date_range,
        "jdbc_write": jdbc_write,
    }


# --- SQL counterparts ---------------------------------------------------------

_TX = """tx AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS sender, CAST(o_custkey AS VARCHAR) AS receiver, l_shipdate AS ts,
         'N' || s_nationkey AS scat, c_mktsegment AS rcat, l_returnflag AS ch
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey)"""

_EV = f"""{_TX}, ev AS (
  SELECT sender AS msisdn, ts AS event_date, scat AS event_category FROM tx WHERE ch IN ('A', 'R') AND sender <> ''
  UNION ALL
  SELECT receiver, ts, rcat FROM tx WHERE ch IN ('N', 'R') AND receiver <> '')"""

_ACTIVE = "SELECT CAST(c_custkey AS VARCHAR) AS msisdn FROM customer WHERE upper(c_mktsegment) = upper('building')"

_LATEST_FIRST = "ORDER BY event_date DESC NULLS LAST, event_category ASC NULLS LAST"

_RANKED = f"SELECT *, row_number() OVER (PARTITION BY msisdn {_LATEST_FIRST}) AS rn FROM ev"

_FEED = """ev AS (
  SELECT CAST(user_id AS VARCHAR) AS msisdn, ts AS event_date, event_type AS event_category FROM events)"""

# The feed as the job reads it: three kinds count, the others are channels without a rule.
_JOB_FEED = f"""ev AS (
  SELECT CAST(user_id AS VARCHAR) AS msisdn, ts AS event_date, event_type AS event_category FROM events
  WHERE event_type IN ('click', 'view', 'purchase')
    AND CAST(user_id AS VARCHAR) IN ({_ACTIVE}))"""

_DAYS = """days AS (
  SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day)"""

_AS_OF = f"""known AS (
  SELECT day, msisdn, event_date, event_category,
         row_number() OVER (PARTITION BY day, msisdn {_LATEST_FIRST}) AS rn
  FROM days JOIN ev ON event_date < day + INTERVAL 1 DAY)"""


def own_oracle_sql() -> dict[str, str]:
    return {
        "last_transaction": f"""
            WITH {_EV}
            SELECT msisdn, event_date AS zb_last_transaction_date, event_category AS zb_user_category
            FROM ({_RANKED} WHERE msisdn IN ({_ACTIVE})) WHERE rn = 1""",
        "output_columns": f"""
            WITH {_EV}
            SELECT msisdn AS party_id, event_date AS zb_last_transaction_date, event_category AS zb_user_category,
                   'building' AS zb_user_status, '2024-01-31' AS day
            FROM ({_RANKED} WHERE msisdn IN ({_ACTIVE})) WHERE rn = 1""",
        "job_days_run": f"""
            WITH {_JOB_FEED}, {_DAYS}, {_AS_OF}
            SELECT msisdn AS party_id, event_date AS zb_last_transaction_date, event_category AS zb_user_category,
                   'building' AS zb_user_status, CAST(day AS VARCHAR) AS day
            FROM known WHERE rn = 1""",
        "late_repair": f"""
            WITH {_JOB_FEED}, {_DAYS}, {_AS_OF}
            SELECT msisdn AS party_id, event_date AS zb_last_transaction_date, event_category AS zb_user_category,
                   'building' AS zb_user_status, CAST(day AS VARCHAR) AS day
            FROM known WHERE rn = 1""",
        "last_click_before": """
            WITH clicks AS (
              SELECT user_id, ts AS clicked, min(event_id) AS click_id, arg_min(value, event_id) AS click_value
              FROM events WHERE event_type = 'click' GROUP BY user_id, ts)
            SELECT e.event_id, e.user_id, e.ts, c.click_id, c.clicked, c.click_value
            FROM events e ASOF LEFT JOIN clicks c ON e.user_id = c.user_id AND e.ts >= c.clicked""",
        "purchase_held": f"""
            WITH {_FEED}, days AS (
              SELECT msisdn, CAST(event_date AS DATE) AS valid_from, max(event_date) AS purchased
              FROM ev WHERE event_category = 'purchase' GROUP BY ALL),
            spans AS (SELECT *, lead(valid_from) OVER (PARTITION BY msisdn ORDER BY valid_from) AS until FROM days)
            SELECT ev.msisdn, event_date AS ts, event_category AS kind, purchased, valid_from
            FROM ev JOIN spans ON ev.msisdn = spans.msisdn AND event_date >= valid_from
                              AND (until IS NULL OR event_date < until)""",
        "snapshot_changes": f"""
            WITH {_FEED}, {_DAYS}, {_AS_OF}, early AS (SELECT * FROM known WHERE rn = 1 AND day = DATE '2024-01-10'),
            late AS (SELECT * FROM known WHERE rn = 1 AND day = DATE '2024-01-20')
            SELECT coalesce(a.msisdn, b.msisdn) AS msisdn,
                   CASE WHEN a.msisdn IS NULL THEN 'appeared' WHEN b.msisdn IS NULL THEN 'vanished' ELSE 'changed' END AS change,
                   a.event_date AS old_event_date, a.event_category AS old_event_category,
                   b.event_date AS new_event_date, b.event_category AS new_event_category
            FROM early a FULL JOIN late b ON a.msisdn = b.msisdn
            WHERE (a.event_date, a.event_category, a.msisdn) IS DISTINCT FROM (b.event_date, b.event_category, b.msisdn)""",
        "snapshot_applied": f"""
            WITH {_FEED}, {_DAYS}, {_AS_OF}
            SELECT msisdn, event_date, event_category FROM known WHERE rn = 1 AND day = DATE '2024-01-20'""",
        "transaction_totals": f"""
            WITH {_TX}
            SELECT ch AS channel, scat AS category, CAST(ts AS DATE) AS sent,
                   CAST(grouping(ch, scat, CAST(ts AS DATE)) AS BIGINT) AS grouping_id,
                   count(*) AS n, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day
            FROM tx GROUP BY GROUPING SETS (
              (ch, scat, CAST(ts AS DATE)), (ch, scat), (ch, CAST(ts AS DATE)), (scat), ())""",
        "moving_week": """
            WITH days AS (
              SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, sum(CAST(floor(value * 100) AS BIGINT)) AS cents,
                     max(value) AS largest
              FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL GROUP BY ALL)
            SELECT user_id, day, CAST(sum(n) OVER week AS BIGINT) AS n, CAST(sum(cents) OVER week AS BIGINT) AS cents,
                   max(largest) OVER week AS largest
            FROM days WINDOW week AS (
              PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
        "merged_sketches": """
            WITH ev AS (
              SELECT event_type, user_id, value FROM events
              WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'),
            every AS (SELECT 0 AS whole, * FROM ev UNION ALL SELECT 1, NULL, user_id, value FROM ev),
            placed AS (SELECT *, row_number() OVER (PARTITION BY whole, event_type ORDER BY value) AS place,
                              count(*) OVER (PARTITION BY whole, event_type) AS size
                       FROM every WHERE value IS NOT NULL),
            counted AS (SELECT whole, event_type, count(*) AS events, count(DISTINCT user_id) AS keys FROM every GROUP BY ALL)
            SELECT c.event_type, events, keys, true AS keys_exact, true AS values_exact,
                   min(value) FILTER (WHERE 100 * place >= 50 * size) AS p50,
                   min(value) FILTER (WHERE 100 * place >= 90 * size) AS p90,
                   min(value) FILTER (WHERE 100 * place >= 99 * size) AS p99
            FROM counted c LEFT JOIN placed p ON c.whole = p.whole AND c.event_type IS NOT DISTINCT FROM p.event_type
            GROUP BY c.whole, c.event_type, events, keys""",
        "user_sessions": f"""
            WITH {_sessions("events", "user_id", "ts")}
            SELECT user_id, min(moment) AS first_event, max(moment) AS last_event, count(*) AS events
            FROM runs GROUP BY user_id, run""",
        "sessions_streamed": f"""
            WITH {_JOB_FEED.partition("WHERE event_type")[0]} WHERE event_type IN ('click', 'view', 'purchase')
              UNION ALL SELECT CAST(user_id AS VARCHAR), ts, event_type FROM events WHERE event_type = 'purchase'),
            {_sessions("ev", "msisdn", "event_date")}
            SELECT msisdn, min(moment) AS first_event, max(moment) AS last_event, count(*) AS events
            FROM runs GROUP BY msisdn, run
            HAVING max(moment) + INTERVAL 6 HOURS <= (SELECT max(event_date) FROM ev) - INTERVAL 3 DAYS""",
        "bucketed_latest": f"""
            WITH {_FEED}
            SELECT msisdn, event_date, event_category FROM ({_RANKED} WHERE msisdn IN ({_ACTIVE})) WHERE rn = 1""",
        "job_streamed": f"""
            WITH {_JOB_FEED}, {_DAYS}, {_AS_OF}
            SELECT msisdn AS party_id, event_date AS zb_last_transaction_date, event_category AS zb_user_category,
                   'building' AS zb_user_status, CAST(day AS VARCHAR) AS day
            FROM known WHERE rn = 1""",
        "job_range_run": f"""
            WITH {_JOB_FEED}
            SELECT msisdn AS party_id, event_date AS zb_last_transaction_date, event_category AS zb_user_category,
                   'building' AS zb_user_status, '2024-01-20' AS day
            FROM ({_RANKED} WHERE event_date >= TIMESTAMP '2024-01-05' AND event_date < TIMESTAMP '2024-01-21')
            WHERE rn = 1""",
        "job_resumed_run": f"""
            WITH {_JOB_FEED}, {_DAYS}, {_AS_OF}
            SELECT msisdn AS party_id, event_date AS zb_last_transaction_date, event_category AS zb_user_category,
                   'building' AS zb_user_status, CAST(day AS VARCHAR) AS day
            FROM known WHERE rn = 1 AND day IN (DATE '2024-01-20', DATE '2024-01-30')""",
        "job_rerun": f"""
            WITH {_JOB_FEED.replace("FROM events", "FROM (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-04')")},
            {_DAYS}, {_AS_OF}
            SELECT msisdn AS party_id, event_date AS zb_last_transaction_date, event_category AS zb_user_category,
                   'building' AS zb_user_status, CAST(day AS VARCHAR) AS day
            FROM known WHERE rn = 1 AND day <= DATE '2024-01-06'""",
        "party_events": f"WITH {_EV} SELECT msisdn, event_date, event_category FROM ev",
        "channel_filter": f"""
            WITH {_TX}
            SELECT sender AS msisdn, ts AS event_date, scat AS event_category FROM tx WHERE ch = 'A' AND sender <> ''""",
        "valid_party_filter": """
            SELECT event_id, CASE WHEN value < 15 THEN ' ' ELSE event_type END AS party
            FROM events WHERE value >= 10 OR value IS NULL""",
        "events_union": f"""
            WITH {_EV}
            SELECT msisdn, event_date, event_category FROM ev
            UNION ALL SELECT CAST(user_id AS VARCHAR), ts, event_type FROM events""",
        "active_filter": _ACTIVE,
        "active_party_events": f"""
            WITH {_EV} SELECT msisdn, event_date, event_category FROM ev WHERE msisdn IN ({_ACTIVE})""",
        "column_mapping": """
            SELECT c_custkey AS msisdn, c_mktsegment AS status, c_nationkey AS category FROM customer""",
        "date_range_filter": _date_range("CAST(user_id AS VARCHAR)"),
        "ranked_events": f"WITH {_EV} {_RANKED}",
        "latest_event": f"WITH {_EV} SELECT msisdn, event_date, event_category FROM ({_RANKED}) WHERE rn = 1",
        "load_metrics": f"""
            WITH {_EV}
            SELECT 'active users' AS stage, count(*) AS row_count FROM ({_ACTIVE})
            UNION ALL SELECT 'transactions', count(*) FROM tx
            UNION ALL SELECT 'events', count(*) FROM ev
            UNION ALL SELECT 'result', count(DISTINCT msisdn) FROM ev WHERE msisdn IN ({_ACTIVE})
            UNION ALL SELECT 'unlisted', 0""",
        "daily_snapshots": f"""
            WITH {_FEED}, {_DAYS}, {_AS_OF}
            SELECT day, msisdn, event_date, event_category FROM known WHERE rn = 1""",
        "advance_state": f"""
            WITH {_FEED} SELECT msisdn, event_date, event_category FROM ({_RANKED}) WHERE rn = 1""",
        "calendar_range": """
            SELECT user_id, CAST(unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)),
                                                        INTERVAL 1 DAY)) AS DATE) AS day
            FROM events GROUP BY user_id""",
        "catchup_calendar": """
            WITH done AS (SELECT user_id, max(CAST(ts AS DATE)) AS done FROM events GROUP BY user_id),
            days AS (
              SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY))
                          AS DATE) AS day)
            SELECT c_custkey AS job, day FROM customer LEFT JOIN done ON c_custkey = user_id
            JOIN days ON day > coalesce(done, DATE '2024-01-29')""",
        "watermark_upsert": """
            SELECT CAST(user_id AS VARCHAR) AS job_identifier, max(CAST(ts AS DATE)) AS last_successfully_processed_date
            FROM events GROUP BY user_id""",
        "watermark_read": """
            SELECT 'purchase' AS job_identifier, max(CAST(ts AS DATE)) AS last_successfully_processed_date,
                   max(CAST(ts AS DATE)) AS reached
            FROM events WHERE event_type = 'purchase'""",
        "parquet_read": "SELECT * FROM orders",
        "file_pattern_read": "SELECT * FROM customer",
        "landing_dir_read": "SELECT * FROM lineitem",
        "landing_dir_write": "SELECT * FROM customer",
        "parquet_write": "SELECT * FROM lineitem",
        "csv_roundtrip": "SELECT * FROM events",
        "json_roundtrip": "SELECT * FROM conversations",
        "orc_roundtrip": "SELECT * FROM orders",
        "text_roundtrip": "SELECT * FROM documents",
        "partitioned_write": "SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events",
        "partition_overwrite": """
            SELECT event_id, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN -value ELSE value END AS value,
                   strftime(ts, '%Y-%m-%d') AS day
            FROM events""",
        "write_modes": "SELECT o_orderkey, 2 * count(*) AS copies FROM orders GROUP BY o_orderkey",
        "jdbc_table_read": "SELECT * FROM customer",
        "jdbc_query_read": _ACTIVE,
        "jdbc_partitioned_read": "SELECT * FROM orders",
        "jdbc_date_range": _date_range("CAST(user_id AS VARCHAR)"),
        "jdbc_write": """
            SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
            UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders""",
    }


def _sessions(rows: str, key: str, time: str) -> str:
    return f"""
        starts AS (
          SELECT {key}, {time} AS moment,
                 CASE WHEN {time} <= lag({time}) OVER (PARTITION BY {key} ORDER BY {time}) + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS new
          FROM {rows} WHERE {key} IS NOT NULL AND {time} IS NOT NULL),
        runs AS (
          SELECT *, sum(new) OVER (PARTITION BY {key} ORDER BY moment RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM starts)"""


def _date_range(party: str) -> str:
    return f"""
        SELECT {party} AS sender_msisdn, {party} AS receiver_msisdn, ts AS transaction_date,
               event_type AS sender_category, event_type AS receiver_category, event_type AS channel
        FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-13'"""
