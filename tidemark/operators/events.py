"""Transactions to party events."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import has_party
from tidemark.names import CATEGORY, CHANNEL_RULES, PARTY, ROLES, TIME


def party_events(
    transactions: DataFrame,
    rules: Mapping[str, Iterable[str]] = CHANNEL_RULES,
    *,
    channel: str = "channel",
    time: str = "transaction_date",
    roles: Mapping[str, tuple[str, str]] = ROLES,
) -> DataFrame:
    """One event per party that counts as acting in a transaction.

    `rules` maps a channel (any case) to roles, `roles` a role to its (id, category) columns. Rows on
    an unlisted or null channel, and parties with a null or empty id, give no event.

    The source is read once: every row carries the array of its acting parties, and `explode` turns
    it into rows. A union of one filtered branch per channel would scan the source once per branch.
    """
    by_channel: dict[str, list[str]] = {}
    for name, acting in rules.items():
        by_channel.setdefault(name.upper(), []).extend(acting)
    if not by_channel:
        raise ValueError("no channel rules")

    def side(role: str):
        party, category = roles[role]
        return F.struct(F.col(party).alias(PARTY), F.col(category).alias(CATEGORY))

    on = F.upper(F.col(channel))
    acting = reduce(
        lambda chain, rule: chain.when(on == rule[0], F.array(*[side(r) for r in rule[1]])),
        by_channel.items(),
        F,
    )
    events = transactions.where(on.isin(*by_channel)).select(
        F.col(time).alias(TIME), F.explode(acting).alias("acting")
    )
    return events.select(f"acting.{PARTY}", TIME, f"acting.{CATEGORY}").where(has_party(PARTY))


def union_events(*feeds: DataFrame) -> DataFrame:
    """All rows of all feeds, columns matched by name, duplicates kept."""
    return reduce(DataFrame.unionByName, feeds)
