import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import apply_difference, snapshot_difference

ROWS = "msisdn string, day string, event_date timestamp, event_category string"
START = datetime(2024, 1, 1)


def snapshot(seed, n):
    pick = random.Random(seed)
    parties = pick.sample([None, *(f"p{i}" for i in range(60))], n)
    return [(p, None if i % 7 == 0 else "d", pick.choice([None, START, START + timedelta(1)]), pick.choice([None, "A", "B"])) for i, p in enumerate(parties)]


@pytest.mark.parametrize("sizes", [(40, 45), (0, 20), (20, 0), (0, 0)])
def test_against_dictionaries_and_back(spark, sizes):
    for keys in (["msisdn"], ["msisdn", "day"]):
        old, new = (snapshot(seed, n) for seed, n in zip((5, 6), sizes, strict=True))
        old_df, new_df = (spark.createDataFrame(rows, ROWS) for rows in (old, new))
        changes = snapshot_difference(old_df, new_df.select(*reversed(new_df.columns)), keys)
        k = len(keys)
        a, b = {r[:k]: r[k:] for r in old}, {r[:k]: r[k:] for r in new}
        expected = {}
        for key in a.keys() | b.keys():
            if key not in a:
                expected[key] = "appeared"
            elif key not in b:
                expected[key] = "vanished"
            elif a[key] != b[key]:
                expected[key] = "changed"
        found = changes.collect()
        assert {tuple(r[name] for name in keys): r.change for r in found} == expected and len(found) == len(expected)
        for r in found:
            key = tuple(r[name] for name in keys)
            others = [n for n in old_df.columns if n not in keys]
            assert tuple(r[f"old_{n}"] for n in others) == a.get(key, (None,) * len(others))
            assert tuple(r[f"new_{n}"] for n in others) == b.get(key, (None,) * len(others))
        assert sorted(map(str, apply_difference(old_df, changes, keys).collect())) == sorted(map(str, new_df.collect()))


def test_other_columns_are_refused(spark):
    one = spark.createDataFrame([], ROWS)
    with pytest.raises(ValueError, match="event_category"):
        snapshot_difference(one, one.drop("event_category"))


def test_one_exchange(spark):
    rows = spark.createDataFrame(snapshot(1, 30), ROWS)
    plan = snapshot_difference(rows, rows.where("event_category = 'A'"))._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1 and "Join" not in plan
