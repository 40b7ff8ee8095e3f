from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.names import TRANSACTIONS_SCHEMA
from tidemark.operators import latest_event, only_parties, party_events, union_events
from tidemark.plans import calculate_last_transaction, shape_output

DATES = TRANSACTIONS_SCHEMA.replace("timestamp", "date")


def users(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "msisdn string")


def moves(spark, rows, schema=TRANSACTIONS_SCHEMA):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def at(day, hour=0, minute=0, second=0, micro=0):
    return datetime(2024, 3, day, hour, minute, second, micro)


@pytest.fixture(params=["10MB", "-1"], ids=["small-list", "large-list"])
def threshold(spark, request):
    """Both orders of filter and cut: the list is broadcast, or joined after the cut."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_week_of_moves(spark, threshold):
    """Senders, receivers and both sides; an unlisted party; a party whose newest move does not count for it."""
    tx = moves(
        spark,
        [
            ("shop1", "anna", date(2024, 3, 18), "SHOP", "HOME", "O2C"),
            ("anna", "ben", date(2024, 3, 19), "HOME", "WORK", "C2C"),
            ("ben", "shop2", date(2024, 3, 20), "WORK", "SHOP", "C2S"),
            ("shop2", "ben", date(2024, 3, 22), "SHOP", "LATE", "C2S"),
            ("shop1", "cleo", date(2024, 3, 21), "SHOP", "NEW", "O2C"),
            ("dora", "shop1", date(2024, 3, 24), "OTHER", "SHOP", "C2S"),
        ],
        DATES,
    )
    result = calculate_last_transaction(users(spark, "anna", "ben", "cleo", "eve"), tx)
    assert result.columns == ["msisdn", "zb_last_transaction_date", "zb_user_category"]
    assert rows(result) == [
        ("anna", date(2024, 3, 19), "HOME"),
        ("ben", date(2024, 3, 20), "WORK"),
        ("cleo", date(2024, 3, 21), "NEW"),
    ]


@pytest.mark.parametrize("broadcast, join", [(None, "Join"), (True, "BroadcastHashJoin"), (False, "SortMergeJoin")])
def test_broadcast_is_the_callers_choice(spark, broadcast, join):
    tx = moves(spark, [("a", "b", at(1), "A", "B", "C2S"), ("c", "a", at(2), "C", "D", "O2C")])
    result = calculate_last_transaction(users(spark, "a", "z"), tx, broadcast=broadcast)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert join in plan and rows(result) == [("a", at(2), "D")]
    # Only with a small list does the filter come before the cut, that is, below it.
    assert (plan.index(join) > plan.index("WindowGroupLimit")) == (broadcast is True)


def test_channels_in_any_case_and_unknown_ones(spark):
    tx = moves(
        spark,
        [
            ("a", "b", at(1), "A", "B", "c2s"),
            ("c", "d", at(1), "C", "D", None),
            ("e", "f", at(1), "E", "F", "X2X"),
        ],
    )
    assert rows(party_events(tx)) == [("a", at(1), "A")]


def test_own_channel_names(spark):
    tx = moves(spark, [("a", "b", at(1), "A", "B", "SELL"), ("c", "d", at(1), "C", "D", "C2S")])
    spec = {"business_logic": {"channel_c2s": "sell"}}
    assert rows(calculate_last_transaction(users(spark, "a", "c"), tx, spec)) == [("a", at(1), "A")]


def test_one_name_for_two_channels(spark):
    tx = moves(spark, [("a", "b", at(1), "A", "B", "MOVE"), ("c", "d", at(1), "C", "D", "c2c")])
    spec = {"business_logic": {"channel_c2s": "MOVE", "channel_o2c": "move", "channel_c2c": None}}
    result = calculate_last_transaction(users(spark, *"abcd"), tx, spec)
    assert [r[0] for r in rows(result)] == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="no channel rules"):
        party_events(tx, {})


def test_party_without_id_gives_no_event(spark):
    tx = moves(
        spark,
        [
            (None, "b", at(1), "A", "B", "C2C"),
            ("", "c", at(1), "A", "C", "C2C"),
            (" ", "d", at(1), "A", "D", "C2S"),
        ],
    )
    assert rows(party_events(tx)) == [(" ", at(1), "A"), ("b", at(1), "B"), ("c", at(1), "C")]


def test_numeric_ids(spark):
    tx = moves(spark, [("1", "2", at(1), "A", "B", "C2C"), (None, "3", at(1), "A", "C", "C2C")])
    numbers = tx.withColumns({c: F.col(c).cast("long") for c in ("sender_msisdn", "receiver_msisdn")})
    assert rows(party_events(numbers)) == [(1, at(1), "A"), (2, at(1), "B"), (3, at(1), "C")]


def test_sender_is_receiver(spark):
    tx = moves(spark, [("a", "a", at(1), "X", "W", "C2C")])
    assert party_events(tx).count() == 2
    assert rows(calculate_last_transaction(users(spark, "a"), tx)) == [("a", at(1), "W")]


def test_ties_and_missing_times(spark, threshold):
    tx = moves(
        spark,
        [
            ("a", None, at(2), "Z", None, "C2S"),
            ("a", None, at(2), "Y", None, "C2S"),
            ("a", None, at(2), None, None, "C2S"),
            ("b", None, None, "K", None, "C2S"),
            ("b", None, None, "J", None, "C2S"),
            ("c", None, None, "J", None, "C2S"),
            ("c", None, at(1), None, None, "C2S"),
        ],
    )
    assert rows(calculate_last_transaction(users(spark, "a", "b", "c"), tx)) == [
        ("a", at(2), "Y"),
        ("b", None, "J"),
        ("c", at(1), None),
    ]


def test_duplicate_users_change_nothing(spark, threshold):
    tx = moves(spark, [("a", "b", at(1), "A", "B", "C2C")])
    twice = users(spark, "a", "a", "b", None)
    assert rows(calculate_last_transaction(twice, tx)) == [("a", at(1), "A"), ("b", at(1), "B")]
    assert only_parties(party_events(tx), twice).count() == 2


@pytest.mark.parametrize("empty", ["users", "transactions"])
def test_empty_input_keeps_the_schema(spark, threshold, empty):
    tx = moves(spark, [] if empty == "transactions" else [("a", "b", at(1), "A", "B", "C2C")])
    result = calculate_last_transaction(users(spark, *([] if empty == "users" else ["a"])), tx)
    assert result.dtypes == [
        ("msisdn", "string"),
        ("zb_last_transaction_date", "timestamp"),
        ("zb_user_category", "string"),
    ]
    assert result.count() == 0


def test_output_columns(spark):
    tx = moves(spark, [("a", "b", at(1), "A", "B", "C2S")])
    shaped = shape_output(calculate_last_transaction(users(spark, "a"), tx), {}, date(2024, 3, 5))
    assert shaped.columns == ["party_id", "zb_last_transaction_date", "zb_user_category", "zb_user_status", "day"]
    assert rows(shaped) == [("a", at(1), "A", "ACTIF", "2024-03-05")]


def stand_in(spark):
    from __spark_entry__ import stand_in_transactions

    return stand_in_transactions(spark, "/root/testdata/sf0.01")


def test_explode_equals_a_union_of_branches(spark):
    tx = stand_in(spark)
    rules = {"A": ["sender"], "N": ["receiver"], "R": ["sender", "receiver"]}

    def branch(channel, role):
        side = tx.where(F.col("channel") == channel)
        return side.select(
            F.col(f"{role}_category").alias("event_category"),
            F.col("transaction_date").alias("event_date"),
            F.col(f"{role}_msisdn").alias("msisdn"),
        )

    union = union_events(*[branch(c, r) for c, roles in rules.items() for r in roles])
    exploded = party_events(tx, rules)
    union = union.select(exploded.columns)
    assert exploded.count() == 80_046
    assert exploded.exceptAll(union).isEmpty() and union.exceptAll(exploded).isEmpty()


def test_source_is_scanned_once_and_cut_before_the_shuffle(spark):
    path = "/root/testdata/sf0.01/events.parquet"
    tx = spark.read.parquet(path).selectExpr(
        "cast(user_id as string) sender_msisdn",
        "cast(user_id as string) receiver_msisdn",
        "ts transaction_date",
        "event_type sender_category",
        "event_type receiver_category",
        "event_type channel",
    )
    events = party_events(tx, {"click": ["sender"], "view": ["receiver"], "purchase": ["sender", "receiver"]})
    plan = latest_event(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    ranking, combining, source = plan.split("Exchange")
    assert "WindowGroupLimit" in combining and "Partial" in combining  # one row per party and task
    assert "partial_max" in source and "Sort " not in source  # one per party, category and task, unsorted
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_large_list_is_joined_after_the_cut(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = party_events(stand_in(spark))
        plan = latest_event(events, users(spark, "1"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("LeftSemi") < plan.index("WindowGroupLimit")
    assert "BroadcastExchange" not in plan
