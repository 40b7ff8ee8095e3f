"""Latest events of parties in two-party transactions, as daily Spark jobs."""

from tidemark.plans import calculate_last_transaction, run_job
from tidemark.sinks import write_output
from tidemark.sources import read_source

__all__ = ["calculate_last_transaction", "read_source", "run_job", "write_output"]
