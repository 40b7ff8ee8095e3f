"""Last transaction per active party."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.names import (
    ACTIVE_STATUS,
    CATEGORY,
    CHANNEL_KEYS,
    CHANNEL_RULES,
    OUT_CATEGORY,
    OUT_DAY,
    OUT_PARTY,
    OUT_STATUS,
    OUT_TIME,
    PARTY,
    TIME,
)
from tidemark.operators import latest_event, party_events


def channel_rules(spec: Mapping[str, Any]) -> dict[str, tuple[str, ...]]:
    """The channel rules under the channel names the job definition gives."""
    logic = spec.get("business_logic", {})
    rules: dict[str, tuple[str, ...]] = {}
    for key, channel in CHANNEL_KEYS.items():
        name = logic.get(key) or channel
        rules[name] = rules.get(name, ()) + CHANNEL_RULES[channel]  # one name may stand for two channels
    return rules


def calculate_last_transaction(
    active_users: DataFrame,
    transactions: DataFrame,
    spec: Mapping[str, Any] | None = None,
    *,
    broadcast: bool | None = None,
) -> DataFrame:
    """Per active party: time and category of its latest transaction in `transactions`.

    No users or no transactions give no rows and the same schema. `broadcast` as in `latest_event`.
    """
    latest = latest_event(party_events(transactions, channel_rules(spec or {})), active_users, broadcast=broadcast)
    return latest.select(PARTY, F.col(TIME).alias(OUT_TIME), F.col(CATEGORY).alias(OUT_CATEGORY))


def shape_output(last: DataFrame, spec: Mapping[str, Any], day: date | Column) -> DataFrame:
    """The published columns; `day` is the ISO day that becomes the partition."""
    status = spec.get("business_logic", {}).get("active_status_value", ACTIVE_STATUS)
    day = F.lit(day.isoformat()) if isinstance(day, date) else F.date_format(day, "yyyy-MM-dd")
    return last.select(
        F.col(PARTY).alias(OUT_PARTY), OUT_TIME, OUT_CATEGORY, F.lit(status).alias(OUT_STATUS), day.alias(OUT_DAY)
    )
