import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import interval_join

START = datetime(1969, 12, 20, 22)  # around 1970, where whole-number division turns
POINTS, SPANS = "id long, k string, at {0}, v string", "k string, since {0}, until {0}, v long, w string"


def tables(seed, skewed):
    pick = random.Random(seed)
    key = lambda: "hot" if skewed and pick.random() < 0.4 else pick.choice("abcdef")
    at = lambda: START + timedelta(minutes=pick.randrange(0, 40 * 24 * 60, 30))
    points = [(i, key(), at(), "x") for i in range(400)] + [(900, None, START, "x"), (901, "a", None, "x"), (902, "new", START, "x")]
    spans = []
    for i in range(200):
        since = at() - timedelta(days=pick.choice([0, 0, 100]))
        length = timedelta(minutes=30) * pick.choice([0, -1, 1, 5, 48, 400, 2000, 10**5])
        spans.append((key(), since, None if pick.random() < 0.1 else since + length, i, "w"))
    return points, [*spans, (None, START, None, 9, "n"), ("a", None, None, 9, "n"), ("a", None, START, 9, "n"), *spans[:5]]


def brute(points, spans):
    return sorted(
        (p[0], s[3], s[4])
        for p in points
        for s in spans
        if None not in (p[1], p[2], s[1]) and p[1] == s[0] and s[1] <= p[2] and (s[2] is None or p[2] < s[2])
    )


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize(("slot", "pieces"), [(60, 2), (3600, 16), (86_400, 1), (10**9, 4)])
def test_against_brute_force(spark, kind, slot, pieces):
    for skewed in (False, True):
        points, spans = tables(slot, skewed)
        found = interval_join(
            spark.createDataFrame(points, POINTS.format(kind)),
            spark.createDataFrame(spans, SPANS.format(kind)).withColumnRenamed("v", "number"),
            "k", "at", "since", "until", ["number", "w"], slot_seconds=slot, pieces=pieces,
        )
        assert found.columns == ["id", "k", "at", "v", "number", "w"]
        expected = brute(points, spans)
        assert len(expected) > 500
        assert sorted((r.id, r.number, r.w) for r in found.collect()) == expected


def test_empty(spark):
    points, spans = (spark.createDataFrame([], ddl.format("timestamp")) for ddl in (POINTS, SPANS))
    some = spark.createDataFrame(tables(1, False)[0], POINTS.format("timestamp"))
    held = spark.createDataFrame(tables(1, False)[1], SPANS.format("timestamp"))
    assert interval_join(points, held, "k", "at", "since", "until", ["w"]).isEmpty()
    assert interval_join(some, spans, "k", "at", "since", "until", ["w"]).isEmpty()


def test_joined_by_key_and_slot_without_a_nested_loop(spark):
    """A span of years among points of weeks takes no more slots than a short one, on few levels."""
    points, spans = tables(3, True)
    df = interval_join(
        spark.createDataFrame(points, POINTS.format("timestamp")),
        spark.createDataFrame(spans, SPANS.format("timestamp")), "k", "at", "since", "until", ["w"], pieces=4,
    )
    plan = df._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in logical.splitlines() if "Join Inner" in line)
    assert "_slot#" in join and "_size#" in join
    from tidemark.operators.intervals import _sizes

    assert len(_sizes(40 * 86_400, 86_400, 4)) <= 3 and len(_sizes(100 * 366 * 86_400, 86_400, 16)) <= 6
