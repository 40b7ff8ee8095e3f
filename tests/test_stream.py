from datetime import date, datetime, timedelta

import pytest

from tests.test_late import AS_OF, published, rows, spec_of
from tidemark import run_job
from tidemark.plans import run_stream
from tidemark.plans import stream as module

SCHEMA = "s string, r string, d timestamp, sc string, rc string, c string"


def prepared(spark, tmp_path):
    users = [(f"p{i}", "on" if i % 3 else "off") for i in range(45)]
    spark.createDataFrame(users, "m string, st string").write.parquet(f"{tmp_path}/users")
    spec = spec_of(tmp_path, "arriving")
    spec["outputs"]["increments"] = {"path": f"{tmp_path}/increments"}
    return spec


def arrive(spark, tmp_path, transactions):
    """One more file in the folder that is followed, and in the one the plain job reads."""
    for folder in ("arriving", "whole"):
        spark.createDataFrame(transactions, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{folder}")


def rebuilt(spark, tmp_path, as_of):
    """What `run_job` publishes from all files, states of the last day included."""
    spec = spec_of(tmp_path, "whole")
    run_job(spark, spec, "initial", as_of, start="2024-01-01", end=(as_of - timedelta(days=1)).isoformat())
    return published(spark, spec)


def last_state(states, day):
    return [row for row in states if f"day={day!r}" in row]


def test_files_of_any_days_equal_the_job_over_all(spark, tmp_path):
    spec = prepared(spark, tmp_path)
    arrive(spark, tmp_path, rows(1, 60, (0, 4)))
    assert run_stream(spark, spec, date(2024, 1, 7)) == date(2024, 1, 6)  # two days without a file are carried
    assert published(spark, spec)[0] == rebuilt(spark, tmp_path, date(2024, 1, 7))[0]
    arrive(spark, tmp_path, rows(2, 30, (1, 3)))  # late
    arrive(spark, tmp_path, rows(3, 30, (8, 12)))  # ahead of the days between
    arrive(spark, tmp_path, rows(4, 30, (5, 14)))  # also days that are not to be published yet
    assert run_stream(spark, spec, AS_OF, files_per_batch=1) == date(2024, 1, 12)
    shown, states = rebuilt(spark, tmp_path, AS_OF)
    now = published(spark, spec)
    day = date(2024, 1, 12)
    assert now[0] == shown and last_state(now[1], day) == last_state(states, day) != []
    # Nothing new: nothing is read; a day later, what was ahead is published.
    assert run_stream(spark, spec, AS_OF) == date(2024, 1, 12) and published(spark, spec) == now
    assert run_stream(spark, spec, date(2024, 1, 15)) == date(2024, 1, 14)
    assert published(spark, spec)[0] == rebuilt(spark, tmp_path, date(2024, 1, 15))[0]


@pytest.mark.parametrize("after", [False, True])
def test_a_batch_that_breaks_off_comes_again(spark, tmp_path, monkeypatch, after):
    spec = prepared(spark, tmp_path)
    for seed in range(3):
        arrive(spark, tmp_path, rows(seed, 30))
    whole, calls = module.fold_batch, []

    def breaks(*args):
        calls.append(args[3])
        if len(calls) == 2:
            if after:
                whole(*args)
            raise RuntimeError("lost")
        whole(*args)

    monkeypatch.setattr(module, "fold_batch", breaks)
    with pytest.raises(Exception, match="lost"):
        run_stream(spark, spec, AS_OF, files_per_batch=1)
    run_stream(spark, spec, AS_OF, files_per_batch=1)
    assert calls == [0, 1, 1, 2]  # the number comes again
    assert published(spark, spec)[0] == rebuilt(spark, tmp_path, AS_OF)[0]


def test_only_rows_without_a_party(spark, tmp_path):
    spec = prepared(spark, tmp_path)
    arrive(spark, tmp_path, [(None, "", datetime(2024, 1, 1), "A", "A", "C2C")])
    assert run_stream(spark, spec, AS_OF) is None


def test_what_cannot_be_streamed_is_refused(spark, tmp_path):
    spec = prepared(spark, tmp_path)
    plain = {**spec["outputs"], "last_transaction_output": {"path": "/nowhere"}}
    with pytest.raises(ValueError, match="partitioned by day"):
        run_stream(spark, {**spec, "outputs": plain}, AS_OF)
    with pytest.raises(ValueError, match="increments"):
        run_stream(spark, {**spec, "outputs": {k: v for k, v in spec["outputs"].items() if k != "increments"}}, AS_OF)
    spec["data_sources"]["transactions"] = {"source_type": "jdbc_table", "table": "t"}
    with pytest.raises(ValueError, match="no files to follow"):
        run_stream(spark, spec, AS_OF)
