from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest

from tidemark.operators import rank_events, ranking

START = datetime(2024, 1, 1)


def brute_force(rows):
    """Sorts each party's events in memory."""
    parties = defaultdict(list)
    for party, time, category in rows:
        parties[party].append((time, category))
    floor = datetime.min if not any(isinstance(t, date) and not isinstance(t, datetime) for _, t, _ in rows) else date.min
    ranked = []
    for party, events in parties.items():
        events.sort(key=lambda e: (e[1] is None, e[1] or ""))
        events.sort(key=lambda e: (e[0] is not None, e[0] or floor), reverse=True)
        ranked += [(party, *event, n) for n, event in enumerate(events, 1)]
    return sorted(ranked, key=str)


def check(spark, rows, time_type):
    df = spark.createDataFrame(rows, f"msisdn string, event_date {time_type}, event_category string")
    assert sorted((tuple(r) for r in rank_events(df).collect()), key=str) == brute_force(rows)


@pytest.mark.parametrize("time_type", ["timestamp", "timestamp_ntz"])
def test_hot_party_copies_and_nulls(spark, monkeypatch, time_type):
    monkeypatch.setattr(ranking, "_BLOCK", 7)
    rows = [("hot", START + timedelta(minutes=13 * i), "ABC"[i % 3]) for i in range(400)]
    rows += [("hot", START, "A")] * 50 + [("hot", None, None)] * 20 + [("hot", None, "B")] * 7
    rows += [("hot", START + timedelta(hours=2), None)] * 3
    rows += [(f"p{i % 9}", START + timedelta(seconds=i // 2), "AB"[i % 2]) for i in range(90)]
    check(spark, rows, time_type)


@pytest.mark.parametrize("time_type", ["timestamp", "timestamp_ntz"])
def test_burst_hour_of_one_party(spark, monkeypatch, time_type):
    """An hour with nearly all events is cut into seconds, and no window holds more than one of those."""
    monkeypatch.setattr(ranking, "_LARGE", 50)
    rows = [("hot", START + timedelta(milliseconds=4500 * i), "ABC"[i % 3]) for i in range(800)]
    rows += [("hot", START + timedelta(hours=h), "Z") for h in range(-5, 6)] + [("hot", None, "N")] * 3
    rows += [("cold", START + timedelta(minutes=i), "A") for i in range(40)]
    rows += [("old", datetime(1969, 12, 31, 23, 59, 59, 500000) + timedelta(milliseconds=400 * i), "A") for i in range(90)]
    check(spark, rows, time_type)
    df = spark.createDataFrame(rows, f"msisdn string, event_date {time_type}, event_category string")
    plan = rank_events(df)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" not in plan


def shuffled_rows(df):
    """Rows written to shuffles by a query that has run."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_parties_of_common_size_are_shuffled_twice(spark):
    """Once to count equal events and once to rank; before, rows per hour were shuffled three times more."""
    rows = [(f"p{i % 700}", date(2024, 1, 1) + timedelta(days=i // 700), "AB"[i % 2]) for i in range(21_000)]
    df = spark.createDataFrame(rows, "msisdn string, event_date date, event_category string")
    ranked = rank_events(df)
    assert len(ranked.collect()) == len(rows)
    assert 2 * len(rows) <= shuffled_rows(ranked) < 2.5 * len(rows)


def test_dates(spark):
    check(spark, [(p, date(2024, 1, 1 + i % 5), "BA"[i % 2]) for i in range(20) for p in "xy"], "date")


def test_clock_change(spark):
    """An hour that occurs twice on the local clock must not mix up the order."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        seconds = [1729983600 + 600 * i for i in range(24)]  # 2024-10-27 01:00 to 05:00 local time
        df = spark.createDataFrame([("a", s) for s in seconds], "msisdn string, s long").selectExpr(
            "msisdn", "timestamp_seconds(s) event_date", "cast(null as string) event_category", "s"
        )
        ranked = rank_events(df.drop("s")).selectExpr("unix_seconds(event_date)", "rn")
        assert {n: s for s, n in ranked.collect()} == dict(enumerate(sorted(seconds, reverse=True), 1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
