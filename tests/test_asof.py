import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import asof_join

START = datetime(2024, 3, 30, 22)
LEFT, RIGHT = "id long, k string, at {0}, v string", "k string, seen {0}, v long, w string"


def brute(left, right):
    out = []
    for row in left:
        found = [r for r in right if None not in (row[1], row[2], r[0], r[1]) and r[0] == row[1] and r[1] <= row[2]]
        # Of the newest, the least values; nulls first.
        newest = [r for r in found if r[1] == max(f[1] for f in found)]
        best = min(newest, key=lambda r: ((r[2] is not None, r[2] or 0), (r[3] is not None, r[3] or "")), default=None)
        out.append((row[0], None if best is None else best[2], None if best is None else best[3]))
    return sorted(out, key=str)


def tables(seed, skewed):
    pick = random.Random(seed)
    key = lambda: "hot" if skewed and pick.random() < 0.4 else pick.choice("abcdefgh")
    at = lambda: START + timedelta(minutes=pick.randrange(0, 600, 5))
    left = [(i, key(), at(), "x") for i in range(600)] + [(900, None, START, "x"), (901, "a", None, "x"), (902, "new", START, "x")]
    right = [(key(), at(), pick.choice([None, 1, 2, 3]), pick.choice([None, "p", "q"])) for _ in range(300)]
    return left, [*right, (None, START, 9, "n"), ("a", None, 9, "n"), *right[:5]]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("slot", [300, 3600, 10**7])
def test_against_brute_force(spark, kind, slot):
    for skewed in (False, True):
        left, right = tables(slot, skewed)
        found = asof_join(
            spark.createDataFrame(left, LEFT.format(kind)),
            spark.createDataFrame(right, RIGHT.format(kind)).withColumnRenamed("v", "rv"),
            "k", "at", ["rv", "w"], right_time="seen", slot_seconds=slot,
        )
        assert found.columns == ["id", "k", "at", "v", "rv", "w"]
        assert sorted(((r.id, r.rv, r.w) for r in found.collect()), key=str) == brute(left, right)


def test_empty(spark):
    left, right = tables(1, False)
    some, none = spark.createDataFrame(left, LEFT.format("timestamp")), spark.createDataFrame([], RIGHT.format("timestamp"))
    assert {r.w for r in asof_join(some, none, "k", "at", ["w"], right_time="seen").collect()} == {None}
    some = spark.createDataFrame(right, RIGHT.format("timestamp"))
    none = spark.createDataFrame([], LEFT.format("timestamp"))
    assert asof_join(none, some, "k", "at", ["w"], right_time="seen").isEmpty()


def test_no_window_over_the_raw_rows_of_a_key(spark):
    """Rows are windowed by key and slot; over a key alone only the slots' ends are."""
    left, right = tables(2, True)
    df = asof_join(
        spark.createDataFrame(left, LEFT.format("timestamp")),
        spark.createDataFrame(right, RIGHT.format("timestamp")), "k", "at", ["w"], right_time="seen",
    )
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and "Join Inner" not in plan and "Cartesian" not in plan
    assert any("[_key#" in w and "_slot#" in w.split("],")[1] for w in windows)
    by_key = next(w for w in windows if "_slot#" not in w.split("],")[1])
    assert "_end#" in by_key
