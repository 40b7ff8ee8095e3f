import random
from datetime import date, datetime, timedelta

import pytest

from tidemark.operators import daily_sketches, merge_sketches

SCHEMA = "kind string, place string, who long, at timestamp, amount double"
PERCENTS = [1, 50, 90, 100]


def rows(seed, n, people=60):
    pick = random.Random(seed)
    odd = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 5e-324, 1.7e308, -1e-9]
    return [
        (
            pick.choice(["a", "b", None]),
            "hot" if pick.random() < 0.5 else pick.choice("xy"),
            None if pick.random() < 0.05 else pick.randrange(people),
            None if pick.random() < 0.02 else datetime(2024, 1, 1) + timedelta(hours=pick.randrange(240)),
            pick.choice(odd) if pick.random() < 0.1 else pick.choice([-1, 1]) * pick.lognormvariate(2, 2),
        )
        for _ in range(n)
    ]


def exact(data, by, first, last):
    groups = {}
    for row in data:
        if row[3] is not None and first <= row[3].date() <= last:
            groups.setdefault(tuple(row[i] for i in by), []).append(row)
    out = {}
    for group, members in groups.items():
        values = sorted(m[4] for m in members if m[4] is not None and abs(m[4]) < float("inf"))
        points = [values[-(-p * len(values) // 100) - 1] if values else None for p in PERCENTS]
        out[group] = (len(members), len({m[2] for m in members} - {None}), points)
    return out


@pytest.mark.parametrize("by", [["kind", "place"], ["kind"], []])
def test_exact_within_the_lists(spark, tmp_path, by):
    data = rows(1, 800)
    daily_sketches(spark.createDataFrame(data, SCHEMA), ["kind", "place"], "at", "who", "amount").write.parquet(f"{tmp_path}/kept")
    kept = spark.read.parquet(f"{tmp_path}/kept")
    first, last = date(2024, 1, 2), date(2024, 1, 7)
    found = merge_sketches(kept, by, PERCENTS, first=first, last=last).collect()
    expected = exact(data, [["kind", "place"].index(name) for name in by], first, last)
    assert {tuple(r[name] for name in by): (r.events, r.keys, [r[f"p{p}"] for p in PERCENTS]) for r in found} == expected
    assert all(r.keys_exact and r.values_exact for r in found)


def test_within_the_stated_errors_beyond_the_lists(spark):
    data = rows(2, 40_000, people=20_000)
    kept = daily_sketches(spark.createDataFrame(data, SCHEMA), ["kind"], "at", "who", "amount", exact=16)
    assert kept.where("keys is not null or values is not null").isEmpty()
    found = merge_sketches(kept, ["kind"], PERCENTS).collect()
    expected = exact(data, [0], date.min, date.max)
    assert len(found) == 3
    for r in found:
        events, keys, points = expected[(r.kind,)]
        assert r.events == events and not r.keys_exact and not r.values_exact
        assert abs(r.keys - keys) <= 4 * 0.0081 * keys
        for p, point in zip(PERCENTS, points):
            assert abs(r[f"p{p}"] - point) <= 0.0100001 * abs(point), (p, r[f"p{p}"], point)


def test_one_long_day_makes_its_group_alone_an_estimate(spark):
    at = datetime(2024, 1, 1)
    data = [("a", "x", i, at, float(i + 1)) for i in range(50)] + [("b", "x", i, at, 2.0) for i in range(5)]
    data += [("a", "x", 1, at + timedelta(days=1), 3.0)]
    kept = daily_sketches(spark.createDataFrame(data, SCHEMA), ["kind"], "at", "who", "amount", exact=20)
    found = {r.kind: r for r in merge_sketches(kept, ["kind"], [50]).collect()}
    assert not found["a"].keys_exact and not found["a"].values_exact and abs(found["a"].keys - 50) <= 2
    assert found["b"].keys_exact and found["b"].values_exact and (found["b"].keys, found["b"].p50) == (5, 2.0)
    second = merge_sketches(kept, ["kind"], [50], first=date(2024, 1, 2)).collect()
    assert [(r.kind, r.events, r.keys, r.p50, r.keys_exact) for r in second] == [("a", 1, 1, 3.0, True)]


def test_only_nulls_and_nothing(spark):
    nulls = spark.createDataFrame([("a", "x", None, datetime(2024, 1, 1), None), ("a", "x", 1, None, 1.0)], SCHEMA)
    (row,) = merge_sketches(daily_sketches(nulls, ["kind"], "at", "who", "amount"), ["kind"], [50]).collect()
    assert (row.kind, row.events, row["keys"], row.keys_exact, row.p50, row.values_exact) == ("a", 1, 0, True, None, True)
    empty = daily_sketches(spark.createDataFrame([], SCHEMA), ["kind"], "at", "who", "amount")
    assert empty.isEmpty() and merge_sketches(empty, ["kind"], [50]).isEmpty() and merge_sketches(empty, [], [50]).isEmpty()
    with pytest.raises(ValueError, match="percents"):
        merge_sketches(empty, ["kind"], [0])


def test_events_are_read_once(spark, tmp_path):
    spark.createDataFrame(rows(3, 200), SCHEMA).write.parquet(f"{tmp_path}/t")
    events = spark.read.parquet(f"{tmp_path}/t")
    kept = daily_sketches(events, ["kind"], "at", "who", "amount")
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "Join" not in plan
    assert "place:" not in plan.partition("ReadSchema")[2]
