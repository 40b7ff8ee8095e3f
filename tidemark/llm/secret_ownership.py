"""Secrets, told apart by who else has them.

Patterns find candidates in every text. The value of each is hashed, and the hashes are counted over the
whole corpus by distinct owners and repositories: a credential that many owners hold is an example that
was copied around, one that a single owner holds and that looks random may be live. A value that some
text assigns to a password is also found where it stands alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import saved

KINDS = ("assign", "access", "hex", "bare")
_KEYWORDS = ("password", "passwd", "secret", "token", "key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_LEAST = 6  # characters of an assigned value
_BARE = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
_PIECE = re.compile(r"[^.]+")
_PLACEHOLDER = re.compile(r"example|sample|dummy|test|changeme|xxxx|your|placeholder|0000|1234567", re.IGNORECASE)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """`(start, end, kind, value)` of the base patterns, leftmost and non-overlapping per kind, by start and kind."""
    found = []
    low = text.lower()  # only to see whether a search pays; places come from the text itself
    if any(word in low for word in _KEYWORDS):
        for match in _ASSIGN.finditer(text):
            if len(match[2]) >= _LEAST:
                found.append((match.start(), match.end(), 0, match[2]))
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if any(len(word) >= 24 for word in text.split()):
        found += [(m.start(), m.end(), 2, m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def bare_tokens(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Tokens of letters and digits outside the base spans, each as all the values that it can stand for.

    These are the token, the token without full stops around it, what is between full stops, and of each
    of them what is behind the first equals sign.
    """
    out, i = [], 0
    ends = sorted((start, end) for start, end, *_ in taken)
    for match in _BARE.finditer(text):
        token, at = match[0], match.start()
        if not any(c.isdigit() for c in token):
            continue
        while i < len(ends) and ends[i][1] <= at:
            i += 1
        left = len(token) - len(token.lstrip("."))
        spans = {(0, len(token)), (left, len(token.rstrip(".")))} | {m.span() for m in _PIECE.finditer(token)}
        spans |= {(start + token[start:end].index("=") + 1, end) for start, end in spans if "=" in token[start:end]}
        for start, end in sorted(spans):
            value = token[start:end]
            if end - start < _LEAST or not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
                continue
            near = i
            while near < len(ends) and ends[near][1] <= at + start:
                near += 1
            if near == len(ends) or ends[near][0] >= at + end:
                out.append((at + start, at + end, 3, value))
    return out


def looks_random(value: str) -> bool:
    """Enough different characters for its length, and not the usual stand-ins."""
    if len(value) < 8 or _PLACEHOLDER.search(value):
        return False
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    return entropy >= min(3.0, 0.75 * math.log2(len(value)))


def _candidates(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = []
        for text in batch:
            base = base_spans(text) if text else []
            bare = bare_tokens(text, base) if text else []
            rows.append(
                [
                    {
                        "start": start, "end": end, "kind": kind,
                        "hash": sha256(value.encode()).digest()[:16], "random": looks_random(value),
                    }
                    for start, end, kind, value in base + bare
                ]
            )
        yield pd.DataFrame({"candidates": rows})


def scan_secrets(
    docs: DataFrame,
    *,
    owner: str | Column = "owner",
    repository: str | Column = "repository",
    doc_id: str = "doc_id",
    text: str = "text",
    copied_owners: int = 3,
) -> DataFrame:
    """Secrets in every whole text, with the corpus's verdict on each.

    One row per input row: `doc_id`, `base` (spans of the base patterns) and `spans` (those, and the
    tokens whose value is a base secret elsewhere, held by fewer than `copied_owners` owners and random).
    A span has `start, end, kind` (a place in KINDS), `owners, repositories` and `verdict`: `copied` from
    `copied_owners` owners on, else `live` if it looks random, else `weak`. Owners and repositories
    are compared as text, nulls as one unknown owner. Null and empty texts have no spans; null ids and
    repeated rows stay, with the same verdicts; other columns are ignored. An empty table gives no rows.
    """
    owner, repository = (F.col(c) if isinstance(c, str) else c for c in (owner, repository))
    struct = "struct<start:int,end:int,kind:int,hash:binary,random:boolean>"
    search = F.pandas_udf(_candidates, f"candidates array<{struct}>")
    found = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        search(F.col(text).cast("string"))["candidates"].alias("candidates"),
    )
    found = saved(found.withColumn("row", F.monotonically_increasing_id()), "secrets")
    each = found.where(F.size("candidates") > 0).select("row", "owner", "repository", F.inline("candidates"))

    # Each step is combined before its shuffle, so a value that everyone holds sends few rows.
    held = each.groupBy("hash", "owner", "repository").agg(F.max(F.col("kind") < 3).alias("base"))
    held = held.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.max("base").alias("base"))
    held = held.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.max("base").alias("base")
    )
    # Tokens that are no secret anywhere end here.
    known = saved(held.where("base").drop("base"), "owners")
    verdict = (
        F.when(F.col("owners") >= copied_owners, "copied").when(F.col("random"), "live").otherwise("weak")
    )
    spans = each.join(known, "hash").withColumn("verdict", verdict)
    spans = spans.where((F.col("kind") < 3) | (F.col("verdict") == "live"))
    one = F.struct("start", "kind", "end", "owners", "repositories", "verdict")
    spans = spans.groupBy("row").agg(F.sort_array(F.collect_list(one)).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    joined = found.select("row", "doc_id").join(spans, "row", "left")
    joined = joined.select("doc_id", F.coalesce("spans", empty).alias("spans"))
    return joined.select("doc_id", F.filter("spans", lambda s: s["kind"] < 3).alias("base"), "spans")


def spans_text(spans: str | Column) -> Column:
    """`kind:start:end` of each span, comma-joined, in the order of the array."""
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
