"""Operators for training text at scale. Each takes and returns DataFrames."""
