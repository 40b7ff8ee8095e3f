"""Options for a named connection, merged once."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping
from typing import Any

log = logging.getLogger(__name__)

# Where and as whom to connect is the connection's business; a job may tune behaviour only.
PROTECTED = {"url", "connection.uri", "user", "password", "driver", "dbtable", "query", "database"}


def merge_options(*layers: Mapping[str, Any] | None) -> dict[str, Any]:
    """Later layers win, except on protected keys, which only the first layer may set."""
    base, *overrides = layers
    merged = dict(base or {})
    for layer in overrides:
        for key, value in (layer or {}).items():
            if key.lower() in PROTECTED:
                log.warning("option %r belongs to the connection; override ignored", key)
            else:
                merged[key] = value
    return merged


def connection(spec: Mapping[str, Any], entry: Mapping[str, Any]) -> dict[str, Any]:
    """The options of the connection an entry names. Credentials come from the caller's spec."""
    name = entry.get("connection_name")
    try:
        return dict(spec["connections"][name])
    except KeyError:
        raise ValueError(f"connection {name!r} is not defined") from None


def mongo_options(
    options: Mapping[str, Any], collection: str, pipeline: list | str | None = None
) -> dict[str, Any]:
    """Options of the `mongodb` data source; a pipeline runs on the server."""
    if not collection:
        raise ValueError("a collection is required")
    result = {**options, "collection": collection}
    if pipeline is None:
        return result
    if not isinstance(pipeline, (list, str)):
        raise TypeError(f"pipeline must be a list of stages or a JSON string, not {type(pipeline).__name__}")
    if not pipeline:
        raise ValueError("the pipeline is empty")
    result["aggregation.pipeline"] = pipeline if isinstance(pipeline, str) else json.dumps(pipeline)
    return result
