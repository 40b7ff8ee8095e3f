"""Column expressions shared by the operators; all built-in, none run Python per row."""

from tidemark.functions.predicates import has_party, on_days, same_text

__all__ = ["has_party", "on_days", "same_text"]
