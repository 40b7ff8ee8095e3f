"""What a Python worker keeps from one task to the next."""

from __future__ import annotations

import gc

_held: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """The operator's tables in this process, which another operator's next task drops.

    Spark uses its workers again: without this, the tables of one stage fill the executor's memory in all later ones.
    """
    if operator not in _held:
        _held.clear()
        gc.collect()
        _held[operator] = {}
    return _held[operator]
