"""DataFrame operators: unpivot, join, rank, snapshot, calendar."""

from tidemark.operators.asof import asof_join
from tidemark.operators.calendar import catchup_days, each_day, processing_days, processing_range
from tidemark.operators.difference import apply_difference, snapshot_difference
from tidemark.operators.events import party_events, union_events
from tidemark.operators.intervals import interval_join
from tidemark.operators.late import late_changes, with_changes
from tidemark.operators.latest import (
    latest_event,
    latest_first,
    latest_per_key,
    newest_per_category,
    only_parties,
)
from tidemark.operators.metrics import StageCounts, whole_plans
from tidemark.operators.ranking import rank_events
from tidemark.operators.sessions import sessions
from tidemark.operators.sketches import daily_sketches, merge_sketches
from tidemark.operators.snapshots import (
    advance_state,
    daily_snapshots,
    expand_days,
    newest_per_category_and_day,
    validity,
)
from tidemark.operators.totals import moving_totals, totals_by

__all__ = [
    "StageCounts",
    "advance_state",
    "apply_difference",
    "asof_join",
    "catchup_days",
    "daily_sketches",
    "daily_snapshots",
    "each_day",
    "expand_days",
    "interval_join",
    "late_changes",
    "latest_event",
    "latest_first",
    "latest_per_key",
    "merge_sketches",
    "moving_totals",
    "newest_per_category",
    "newest_per_category_and_day",
    "only_parties",
    "party_events",
    "processing_days",
    "processing_range",
    "rank_events",
    "sessions",
    "snapshot_difference",
    "totals_by",
    "union_events",
    "validity",
    "whole_plans",
    "with_changes",
]
