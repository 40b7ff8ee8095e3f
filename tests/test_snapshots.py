from datetime import date, timedelta

from __spark_entry__ import feed
from tidemark.operators import advance_state, daily_snapshots, latest_event, validity

SF = "/root/testdata/sf0.001"
FIRST = date(2024, 1, 1)


def rows(df):
    return sorted(map(tuple, df.select("msisdn", "event_date", "event_category").collect()))


def test_fold_day_by_day_equals_one_job(spark):
    events = feed(spark, SF).cache()
    last = FIRST + timedelta(days=6)
    whole = daily_snapshots(events, FIRST, last).cache()
    schema = events.select("msisdn", "event_date", "event_category").schema
    state = spark.createDataFrame([], schema)
    for n in range(7):
        day = FIRST + timedelta(days=n)
        state = spark.createDataFrame(advance_state(state, events, day).collect(), schema)
        assert rows(state) == rows(whole.where(f"day = '{day}'")) != []


def test_earlier_state_replaces_earlier_events(spark):
    events = feed(spark, SF)
    cut, last = FIRST + timedelta(days=10), FIRST + timedelta(days=29)
    before = latest_event(events.where(f"event_date < '{cut}'"))
    after = events.where(f"event_date >= '{cut}'")
    resumed = daily_snapshots(after, cut, last, before)
    full = daily_snapshots(events, cut, last)
    assert resumed.exceptAll(full).isEmpty() and full.exceptAll(resumed).isEmpty()


def test_same_range_twice_is_the_same_state(spark):
    events = feed(spark, SF)
    last = FIRST + timedelta(days=29)
    once = latest_event(events)
    assert rows(advance_state(once, events, FIRST, last)) == rows(once)


def test_validity_has_no_gap_or_overlap(spark):
    spans = {}
    for r in validity(feed(spark, SF)).orderBy("msisdn", "valid_from").collect():
        spans.setdefault(r.msisdn, []).append((r.valid_from, r.valid_to))
    for party in spans.values():
        assert party[-1][1] is None
        assert all(end + timedelta(days=1) == start for (_, end), (start, _) in zip(party, party[1:]))


def test_events_are_cut_before_they_are_sorted(spark):
    plan = validity(feed(spark, SF))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning") :]
    assert "partial_max" in below and "Sort" not in below
