"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans. The tokens of the field are these and everything else in the text that
might be one: numbers, words with an at sign, and words equal to the local part of an address. Tokens that
follow each other closely are joined by chain factors. Distant tokens that repeat each other (the same
last digits, the same local part) are joined by skip factors, each to the first of them, a base token if there
is one, so a token that occurs a thousand times has a thousand edges. Base tokens are observed; loopy message passing carries
their labels along the edges to the others. A token is added if its label is clear and a base
token of the same label backs it.

The weights are fitted by pseudo-likelihood on a sample of texts with the base spans as labels. To learn what
a similar token is worth, each text gets other spellings of its base tokens, labelled alike, and numbers
of the same shapes that resemble nothing, labelled as none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.training import thinned

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"[0-9](?:[().\x20-]{0,3}[0-9])*")
_WORD = re.compile(r"[\w.%+-]+")
_PUNCTUATION = """.,;:!?()[]{}<>"'"""
_NEAR = 40  # characters between tokens that a chain factor joins
_TAIL = 7  # last digits that make numbers similar
_SURE = 0.8
_ROUNDS = 12
_FEATURES = 18


# --- base spans ---------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """`(kind, start, end)` by kind as in KINDS, then start; leftmost and non-overlapping per kind."""
    found = []
    at, taken = text.find("@"), 0
    while at >= 0:  # from each at sign to the left: the leftmost start of an address is that of its run
        start = at
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((0, start, domain.end()))
            taken = domain.end()
        at = text.find("@", max(at + 1, taken))
    if _DIGIT.search(text):
        for match in _DOTTED.finditer(text):  # numbers with one dot between them, four by four
            four, at = [], match.start()
            for part in match[0].split("."):
                four = [*four, (part.lstrip("0") or "0", at)] if part else []
                at += len(part) + 1
                if len(four) == 4:
                    if all(len(value) <= 3 and int(value) <= 255 for value, _ in four):
                        found.append((1, four[0][1], at - 1))
                    four = []
        for match in _CARD.finditer(text):
            digits = match[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, match.start(), match.end()))
        if "+" in text:
            for match in _PHONE.finditer(text):
                if 8 <= len(_digits(match[0])) <= 15:
                    found.append((3, match.start(), match.end()))
    return found


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


# --- the field ----------------------------------------------------------------


@dataclass(frozen=True)
class Graph:
    """Tokens `(start, end, label or -1 if not observed)`, their features, and edges `(left, right, skip)`."""

    tokens: list[tuple[int, int, int]]
    features: np.ndarray
    edges: list[tuple[int, int, int]]


def _features(text: str, start: int, end: int) -> list[float]:
    """The shape of a token and what stands before it."""
    token = text[start:end]
    digits = _digits(token)
    n, before = len(digits), text[max(0, start - 2) : start]
    return [
        1.0, "@" in token, token[:1] == "+" or before.endswith("+"), 1 <= n <= 3, 4 <= n <= 6, n == 7, 8 <= n <= 9,
        10 <= n <= 12, 13 <= n <= 15, 16 <= n <= 19, n > 19, 13 <= n <= 19 and luhn(digits), token.count(".") == 3,
        "." in token, "-" in token, "(" in token or before.endswith("("), " " in token, n == 0,
    ]


def _keys(token: str) -> list[str]:
    """What makes a token similar to others: its last digits, its local part, all of it."""
    out = []
    if "@" in token:
        out.append(f"a:{token.partition('@')[0].lower()}")
    elif any(c.isalpha() for c in token):
        out.append(f"a:{token.lower()}")
    digits = _digits(token)
    if len(digits) >= _TAIL and "@" not in token:
        out.append(f"d:{digits[-_TAIL:]}")
    return out


def _around_at(text: str) -> Iterator[tuple[int, int]]:
    """What stands around each at sign up to white space or another one, without punctuation at its ends."""
    at = text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start and text[start - 1] != "@" and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and text[end] != "@" and not text[end].isspace():
            end += 1
        token = text[start:end]
        yield start + len(token) - len(token.lstrip(_PUNCTUATION)), start + len(token.rstrip(_PUNCTUATION))
        at = text.find("@", end)


def graph(text: str, base: list[tuple[int, int, int]]) -> Graph:
    """The field over one text."""
    tokens = [(start, end, kind + 1) for kind, start, end in base]
    taken = sorted((start, end) for _, start, end in base)

    def free(start: int, end: int) -> bool:
        lo = np.searchsorted(starts, end)
        return not len(starts) or lo == 0 or tops[lo - 1] <= start

    starts = np.array([s for s, _ in taken])
    tops = np.maximum.accumulate(np.array([e for _, e in taken])) if taken else starts
    others = set(_around_at(text))
    others |= {(m.start(), m.end()) for m in _NUMBER.finditer(text)} if _DIGIT.search(text) else set()
    names = {text[start:end].partition("@")[0].lower() for kind, start, end in base if kind == 0}
    names = {name for name in names if len(name) >= 4}
    if names:
        words = ((m.start(), m[0].rstrip(".-")) for m in _WORD.finditer(text))
        others |= {(start, start + len(word)) for start, word in words if word.lower() in names}
    last = -1
    for start, end in sorted(others, key=lambda span: (span[0], -span[1])):
        if start >= last and free(start, end):
            tokens.append((start, end, -1))
            last = end
    tokens.sort()
    edges, seen = [(i - 1, i, 0) for i in range(1, len(tokens)) if tokens[i][0] - tokens[i - 1][1] <= _NEAR], {}
    for i in sorted(range(len(tokens)), key=lambda i: (tokens[i][2] < 0, i)):  # base tokens first
        for key in _keys(text[tokens[i][0] : tokens[i][1]]):
            first = seen.setdefault(key, i)
            if first != i:
                edges.append((first, i, 1))
    rows = np.array([_features(text, start, end) for start, end, _ in tokens], float).reshape(-1, _FEATURES)
    return Graph(tokens, rows, edges)


@dataclass(frozen=True)
class Field:
    """Weights: shape by label, label by label along the chain, and between similar tokens."""

    shape: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def marginals(field: Field, net: Graph) -> np.ndarray:
    """Chance of each label for each token, by loopy sum-product passing with damping."""
    own = net.features @ field.shape
    for i, (_, _, label) in enumerate(net.tokens):
        if label >= 0:
            own[i] = -50.0
            own[i, label] = 0.0
    if not net.edges:
        return _normal(own)
    left, right, kind = np.array(net.edges).T
    factor = np.where((kind == 1)[:, None, None], field.skip, field.chain)
    source, target = np.concatenate([left, right]), np.concatenate([right, left])
    factor = np.concatenate([factor, factor.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(left)) + len(left), np.arange(len(left))])
    messages = np.zeros((len(source), len(LABELS)))
    for _ in range(_ROUNDS):
        belief = own.copy()
        np.add.at(belief, target, messages)
        out = belief[source] - messages[back]
        new = _log_sum(out[:, :, None] + factor)
        new -= new.max(axis=1, keepdims=True)
        messages = 0.5 * messages + 0.5 * new
    belief = own.copy()
    np.add.at(belief, target, messages)
    return _normal(belief)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=1)) + top[:, 0]


def _normal(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(field: Field, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans beside the base ones, as `(kind, start, end)`."""
    if not base:
        return []
    net = graph(text, base)
    if len(net.tokens) == len(base) or not any(skip for *_, skip in net.edges):
        return []
    # What backs a token: the labels that base tokens similar to it have.
    group = list(range(len(net.tokens)))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for a, b, skip in net.edges:
        if skip:
            group[root(b)] = root(a)
    backed = {(root(i), label) for i, (_, _, label) in enumerate(net.tokens) if label > 0}
    chances = marginals(field, net)
    out = []
    for i, (start, end, label) in enumerate(net.tokens):
        best = int(chances[i].argmax())
        if label < 0 and best and chances[i, best] >= _SURE and (root(i), best) in backed:
            out.append((best - 1, start, end))
    return out


# --- fitting ------------------------------------------------------------------


def _spellings(kind: int, token: str) -> list[tuple[str, int]]:
    """Another way to write a base token, with its label, and a look-alike, labelled 0."""
    digits = _digits(token)
    turn = sum(token.encode())  # which way, so that all occur in a sample
    if kind == 0:
        name = token.partition("@")[0]
        return [((f"{name}@host", name)[turn % 2], 1), (f"no.{digits}one@host", 0)] if len(name) >= 4 else []
    if kind == 1 or len(digits) < _TAIL:
        return []
    tail, by = digits[-10:] if kind == 3 else digits[-8:], (" ", "-", ".", "")[turn % 4]
    other = "".join(str((int(d) * 3 + 1) % 10) for d in tail)
    return [(by.join((d[:-7], d[-7:-4], d[-4:])), label) for d, label in ((tail, kind + 1), (other, 0))]


def _examples(text: str) -> list[list[float]]:
    """A row per token: label, shape, and how many chain and skip neighbours have each label."""
    base = base_spans(text)
    given = {}
    for kind, start, end in base[:: max(1, len(base) // 20)]:
        for token, label in _spellings(kind, text[start:end]):
            text += "\n" + " " * _NEAR + " "
            given[len(text)] = label
            text += token
    net = graph(text, base)
    labels = [given.get(start, 0) if label < 0 else label for start, _, label in net.tokens]
    near = np.zeros((len(labels), 2, 2, len(LABELS)))
    for a, b, skip in net.edges:
        near[a, skip, 1, labels[b]] += 1
        near[b, skip, 0, labels[a]] += 1
    step = max(1, len(labels) // 300)  # of a text with very many tokens, three hundred spread over it
    return [[labels[i], *net.features[i], *near[i].ravel()] for i in range(0, len(labels), step)]


def fit_field(docs: DataFrame, *, sample: int = 3000, text: str = "text", steps: int = 2000) -> Field:
    """Fits the weights on at most `sample` different texts that hold a digit or an at sign, those of least hash; where a text
    has copies, it counts once, and there may be fewer. Of a text about twenty base spans, spread over it, are written in other
    ways, and about three hundred tokens are taken.

    Pseudo-likelihood: each token's label is predicted from its shape and its neighbours' labels. Similar
    tokens share one weight, for having the same label whichever it is.
    """
    texts = docs.select(F.col(text).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    hashed = F.xxhash64("text")
    texts = thinned(texts, hashed, sample).distinct().orderBy(hashed, F.length("text"), "text").limit(sample)
    width = 1 + _FEATURES + 4 * len(LABELS)

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [np.array(_examples(t), np.float32).reshape(-1, width).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"rows": rows}, dtype=object)

    found = sorted(bytes(r["rows"]) for r in texts.mapInPandas(collect, "rows binary").collect())
    return _fit(np.frombuffer(b"".join(found), np.float32).reshape(-1, width).astype(float), steps)


def _fit(data: np.ndarray, steps: int, rate: float = 6.0, ridge: float = 1e-4) -> Field:
    k = len(LABELS)
    shape, chain, agree = np.zeros((_FEATURES, k)), np.zeros((k, k)), 2.0
    if len(data):
        # Rows that are alike are counted once.
        data, weight = np.unique(data, axis=0, return_counts=True)
        label, x, near = data[:, 0].astype(int), data[:, 1 : 1 + _FEATURES], data[:, 1 + _FEATURES :].reshape(-1, 2, 2, k)
        wanted, weight = np.eye(k)[label], weight / weight.sum()
        for _ in range(steps):
            # near[:, kind, side, label]; side 0 is the token before, 1 the one behind.
            similar = near[:, 1, 0] + near[:, 1, 1]
            logits = x @ shape + near[:, 0, 0] @ chain + near[:, 0, 1] @ chain.T + agree * similar
            gap = (wanted - _normal(logits)) * weight[:, None]
            shape += rate * (x.T @ gap - ridge * shape)
            chain += rate * (near[:, 0, 0].T @ gap + gap.T @ near[:, 0, 1] - 10 * ridge * chain)
            agree += rate * ((similar * gap).sum() - ridge * agree)
    return Field(shape, chain, agree * np.eye(k))


# --- the operator -------------------------------------------------------------


def find_personal_data(docs: DataFrame, field: Field, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Personal data in every whole text.

    One row per input row: `doc_id`, `base` and `spans`, arrays of `kind` (a place in KINDS), `start`, `end` in
    code points, by kind, then start; `spans` holds the base spans and those the field adds. Null and
    empty texts have no spans; null ids and repeated rows stay; other columns are ignored. Nothing is
    shuffled. An empty table gives no rows.
    """
    span = "array<struct<kind:int,start:int,end:int>>"

    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = ("kind", "start", "end")
        for batch in texts:
            rows = []
            for one in batch:
                base = base_spans(one) if one else []
                every = sorted(base + added_spans(field, one, base)) if base else []
                rows.append([[dict(zip(names, s)) for s in spans] for spans in (base, every)])
            yield pd.DataFrame(rows, columns=["base", "spans"])

    found = F.pandas_udf(find, f"base {span}, spans {span}")(F.col(text).cast("string"))
    return docs.select(F.col(doc_id).alias("doc_id"), found.alias("found")).select("doc_id", "found.base", "found.spans")


def spans_text(spans: str | Column) -> Column:
    """`kind:start:end` of each span, comma-joined, in the order of the array."""
    names = F.array(*(F.lit(kind) for kind in KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
