"""One run of the job: choose days, load, compute, write, advance progress."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, timedelta
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidemark.names import CATEGORY, OUT_CATEGORY, OUT_DAY, OUT_TIME, TIME
from tidemark.operators import (
    StageCounts,
    expand_days,
    only_parties,
    party_events,
    processing_range,
    validity,
    whole_plans,
)
from tidemark.plans.last_transaction import calculate_last_transaction, channel_rules, shape_output
from tidemark.plans.progress import create_progress, last_done, mark_done
from tidemark.sinks import replaces_partitions, write_output
from tidemark.sources import active_parties, read_source, transactions
from tidemark.storage import delete, exists, matching, materialised

USERS, TRANSACTIONS, OUTPUT, STATE = "users", "transactions", "last_transaction_output", "state"


class ProgressNotRecorded(RuntimeError):
    """The output is complete but the progress table does not say so; repeating the run is safe."""


# Party events from a day on (None: all there are) up to a last day, counted by stage.
EventReader = Callable[[date | None, date, StageCounts], DataFrame]


@dataclass(frozen=True)
class Run:
    """What a run did: its days, or None when there was nothing to do, and rows per stage."""

    first: date | None = None
    last: date | None = None
    rows: dict[str, int] = field(default_factory=dict)


def run_job(
    spark: SparkSession,
    spec: Mapping[str, Any],
    mode: str,
    as_of: date,
    *,
    start: date | str | None = None,
    end: date | str | None = None,
    day: date | str | None = None,
    carry: bool = True,
    history_from: date | None = None,
    broadcast: bool | None = None,
) -> Run:
    """Processes the days `mode` asks for and publishes last transactions of active parties.

    `carry=True` publishes one partition per day: the last known transaction as of that day, however
    old. For later runs the state of the last day and of every month's end is kept, with all parties and
    not only the active ones. A run starts from the newest state before its first day and reads the
    transactions since; without one it reads all transactions up to its last day, or those from
    `history_from` on where nothing older counts. `carry=False` looks only inside the run's days and
    publishes one partition, for the last of them. `broadcast=True` says that the list of active parties
    is small, see `latest_event`.

    Both read the transactions once. Partitions of the run's days are replaced, also by nothing, and a
    whole-table output is replaced by an empty result; progress is appended last and is a maximum: a
    run that broke off, or runs twice, can simply be repeated. A transaction that arrives for a day
    already processed is seen after `initial` from that day on. Any error means that progress did not
    move; sources that are not defined and outputs that are not overwritten are errors before any work.
    """
    _check(spec, carry)
    create_progress(spark, spec)
    done = last_done(spark, spec)
    days = processing_range(mode, as_of, done, start=start, end=end, day=day)
    if days is None:
        return Run()
    with whole_plans(spark):
        if carry:
            rows = publish_days(spark, spec, *days, _read_events(spark, spec, history_from), broadcast)
        else:
            rows = _publish_range(spark, spec, *days, broadcast)
    try:
        mark_done(spark, spec, days[1])
    except Exception as error:
        raise ProgressNotRecorded(f"published {days[0]} to {days[1]}, progress not recorded") from error
    return Run(*days, rows)


def _check(spec: Mapping[str, Any], carry: bool) -> None:
    """What must hold before a run: otherwise progress would tell of days that were not processed."""
    for name in (USERS, TRANSACTIONS):
        if name not in spec.get("data_sources", {}):
            raise ValueError(f"source {name!r} is not defined")
    entry = spec.get("outputs", {}).get(OUTPUT)
    if entry is None:
        raise ValueError(f"output {OUTPUT!r} is not defined")
    mode = (entry.get("options_override") or {}).get("mode") or entry.get("mode") or "overwrite"
    if mode != "overwrite":
        raise ValueError(f"output {OUTPUT!r} has mode {mode!r}: a run that may be repeated must overwrite")
    if carry and not spec["outputs"].get(STATE, {}).get("path"):
        raise ValueError(f"outputs.{STATE} needs a path to carry the last known transactions; or run with carry=False")


def _publish_range(
    spark: SparkSession, spec: Mapping[str, Any], first: date, last: date, broadcast: bool | None
) -> dict[str, int]:
    count = StageCounts()
    active = count("users", active_parties(spark, spec, USERS))
    rows = count("transactions", transactions(spark, spec, first, last, TRANSACTIONS))
    found = count("published", calculate_last_transaction(active, rows, spec, broadcast=broadcast))
    _write_days(shape_output(found, spec, last), spec, OUTPUT, last, last)
    return count.result()


def _read_events(spark: SparkSession, spec: Mapping[str, Any], history_from: date | None) -> EventReader:
    def read(since: date | None, last: date, count: StageCounts) -> DataFrame:
        rows = count("transactions", transactions(spark, spec, since or history_from, last, TRANSACTIONS))
        return party_events(rows, channel_rules(spec))

    return read


def publish_days(
    spark: SparkSession,
    spec: Mapping[str, Any],
    first: date,
    last: date,
    events_of: EventReader,
    broadcast: bool | None,
) -> dict[str, int]:
    """Publishes the days from `first` to `last` and keeps their states, from the newest state before `first` and the
    events since, which `events_of` reads: from a day on, or all if there is no state."""
    place = {"path": spec["outputs"][STATE]["path"]}
    stored = {"data_sources": {STATE: place}}
    count = StageCounts()
    covered = _newest_state(spark, stored, first)
    events = count("events", events_of(covered + timedelta(days=1) if covered else None, last, count))
    state = None
    if covered:
        schema = StructType([*events.schema.fields, StructField(OUT_DAY, DateType())])
        state = read_source(spark, stored, STATE, schema=schema).where(F.col(OUT_DAY) == F.lit(covered))
    active = count("users", active_parties(spark, spec, USERS))
    with materialised(validity(events, state), "validity") as known:
        shown = expand_days(only_parties(known, active, broadcast=broadcast), first, last)
        shown = shown.withColumnsRenamed({TIME: OUT_TIME, CATEGORY: OUT_CATEGORY})
        published = count("published", shape_output(shown, spec, F.col("day")))
        _write_days(published, spec, OUTPUT, first, last)
        kept = expand_days(known, first, last).where((F.col("day") == F.lit(last)) | (F.last_day("day") == F.col("day")))
        states = {"outputs": {STATE: {**place, "partition_by": [OUT_DAY], "mode": "overwrite"}}}
        _write_days(kept, states, STATE, first, last)
    return count.result()


def _write_days(df: DataFrame, spec: Mapping[str, Any], name: str, first: date, last: date) -> None:
    """Replaces the days from `first` to `last` of an output by what `df` has, in one evaluation.

    Days that `df` does not have are removed afterwards. An output without partitions by day is replaced
    as a whole.
    """
    entry = spec["outputs"][name]
    columns = entry.get("partition_by") or []
    columns = [columns] if isinstance(columns, str) else list(columns)
    one_partition = first == last and columns == [OUT_DAY]
    if not replaces_partitions(entry) or OUT_DAY not in columns:
        write_output(df, spec, name, skip_empty=False, rebalance=not one_partition)
        return
    seen = Observation()
    shown = df.observe(seen, F.collect_set(F.col(OUT_DAY).cast("string")).alias("days"))
    write_output(shown, spec, name, skip_empty=False, rebalance=not one_partition)
    held = set(seen.get["days"])
    for n in range((last - first).days + 1):
        gone = (first + timedelta(days=n)).isoformat()
        if gone not in held:
            above = "*/" * columns.index(OUT_DAY)
            for path in matching(df.sparkSession, f"{entry['path'].rstrip('/')}/{above}{OUT_DAY}={gone}"):
                delete(df.sparkSession, path)


def _newest_state(spark: SparkSession, stored: Mapping[str, Any], first: date) -> date | None:
    """The last day before `first` whose state was kept."""
    if not exists(spark, stored["data_sources"][STATE]["path"]):
        return None
    states = read_source(spark, stored, STATE, schema=f"{OUT_DAY} date")
    eve = first - timedelta(days=1)
    if not states.where(F.col(OUT_DAY) == F.lit(eve)).isEmpty():  # the usual case reads one partition
        return eve
    return states.where(F.col(OUT_DAY) < F.lit(eve)).agg(F.max(OUT_DAY)).first()[0]
