"""The job: last transaction per active party, progress, and the run that ties them together."""

from tidemark.plans.job import ProgressNotRecorded, Run, run_job
from tidemark.plans.last_transaction import calculate_last_transaction, channel_rules, shape_output
from tidemark.plans.progress import append_progress, create_progress, last_done, read_progress
from tidemark.plans.repair import repair_job
from tidemark.plans.sessions import read_sessions, run_sessions
from tidemark.plans.stream import run_stream

__all__ = [
    "ProgressNotRecorded",
    "Run",
    "append_progress",
    "calculate_last_transaction",
    "channel_rules",
    "create_progress",
    "last_done",
    "read_progress",
    "read_sessions",
    "repair_job",
    "run_job",
    "run_sessions",
    "run_stream",
    "shape_output",
]
