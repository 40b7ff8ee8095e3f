"""Readers: files, drop folders, JDBC, document stores, all by logical name."""

from tidemark.sources.load import active_parties, require_columns, select_mapped, transaction_stream, transactions
from tidemark.sources.read import read_source, source_type

__all__ = [
    "active_parties",
    "read_source",
    "require_columns",
    "select_mapped",
    "source_type",
    "transaction_stream",
    "transactions",
]
