"""Toxicity from confirmed toxic examples and unlabelled text, by non-negative PU learning.

Features are words and their beginnings. Each comes twice: whether a text has it, which suits words that
clean text never uses, and how often per hundred words, which suits stems that clean text uses now and
then. Linear classifiers are trained by numpy. No text counts as clean; the risk on clean text is
estimated as the risk on unlabelled text less the share of it that is toxic, by the class prior:

    risk = prior * E_toxic[loss(g)] + max(0, E_unlabelled[loss(-g)] - prior * E_toxic[loss(-g)])

Without the bound the second part falls below zero once the classifier learns the toxic examples by heart;
where it does, the step goes the other way until it is back.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.training import labelled_sample, sigmoid

_WORD = re.compile(r"[^\W\d_]+")
_STEMS = (4, 5, 6)
_KEPT = 300_000
_FULL_RATE = 5.0  # occurrences per hundred words beyond which more make no difference


@dataclass(frozen=True)
class ToxicityModel:
    features: tuple[str, ...]
    weights: np.ndarray  # presence of each feature, then its rate, then the constant, one row per classifier

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return (rows @ self.weights[:, :-1].T + self.weights[:, -1]).mean(axis=1)


def word_features(word: str) -> list[str]:
    """The word itself, and its beginnings with a mark behind."""
    return [word, *(word[:n] + "-" for n in _STEMS if len(word) >= n)]


def _words(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def _present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many texts of a batch have each feature."""
    for batch in batches:
        texts = Counter()
        for text in batch["text"]:
            texts.update({feature for word in _words(text) for feature in word_features(word)})
        yield pd.DataFrame({"feature": list(texts), "n": list(texts.values())}).astype({"n": "int64", "feature": "object"})


class _Vectors:
    """Texts to rows of feature values."""

    def __init__(self, features: tuple[str, ...]) -> None:
        self.place = {feature: i for i, feature in enumerate(features)}
        self.known: dict[str, tuple[int, ...]] = {}

    def places(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= _KEPT:
            self.known.clear()
        found = tuple(self.place[f] for f in word_features(word) if f in self.place)
        self.known[word] = found
        return found

    def __call__(self, texts) -> np.ndarray:
        size = len(self.place)
        out = np.zeros((len(texts), 2 * size), np.float32)
        known = self.known
        for i, text in enumerate(texts):
            counts = _words(text)
            total = sum(counts.values())
            for word, n in counts.items():
                at = known.get(word)
                if at is None:
                    at = self.places(word)
                for j in at:
                    out[i, j] = 1
                    out[i, size + j] += 100 * n / total
        rates = out[:, size:]
        np.minimum(rates, _FULL_RATE, out=rates)
        rates /= _FULL_RATE
        return out


def _train(toxic: np.ndarray, other: np.ndarray, prior: float, seed: int, steps: int, rate: float) -> np.ndarray:
    """One linear classifier by Adam on the non-negative risk, with the sigmoid loss."""
    pick = np.random.default_rng(seed)
    weights = np.zeros(toxic.shape[1] + 1)
    weights[-1] = -0.5
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    toxic = np.column_stack([toxic, np.ones(len(toxic), np.float32)])
    other = np.column_stack([other, np.ones(len(other), np.float32)])
    for step in range(1, steps + 1):
        p = toxic[pick.integers(0, len(toxic), min(len(toxic), 256))]
        u = other[pick.integers(0, len(other), min(len(other), 1024))]
        loss_p, loss_u = sigmoid(p @ weights), sigmoid(u @ weights)  # loss(-g); loss(g) is one less it
        slope_p = p.T @ (loss_p * (1 - loss_p)) / len(p)
        slope_u = u.T @ (loss_u * (1 - loss_u)) / len(u)
        clean_risk = loss_u.mean() - prior * loss_p.mean()
        clean_slope = slope_u - prior * slope_p
        slope = -prior * slope_p + clean_slope if clean_risk >= 0 else -clean_slope
        slope = slope + 2e-5 * np.append(weights[:-1], 0)
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights


def fit_toxicity(
    docs: DataFrame,
    toxic: DataFrame,
    *,
    prior: float,
    examples: int = 2000,
    unlabelled: int = 6000,
    features: int = 1500,
    classifiers: int = 3,
    steps: int = 600,
    rate: float = 0.05,
    evidence: float = 15.0,
) -> ToxicityModel | None:
    """Trains on `docs(doc_id, text)` and the ids `toxic(doc_id)` of confirmed toxic ones.

    `prior` is the share of toxic texts among unlabelled ones. At most `examples` toxic and `unlabelled`
    other documents are read, those of least hash. A feature is one that is more frequent among the toxic
    examples than chance explains (`evidence`: likelihood ratio, G squared); at most the `features` of
    most evidence are kept. None without examples, texts or features.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("doc_id is not null")
    ids = toxic.select("doc_id", F.lit(1).alias("label"))
    picked = labelled_sample(ids, examples).select("doc_id")
    rest = texts.select("doc_id", F.lit(0).alias("label")).join(ids.select("doc_id"), "doc_id", "left_anti")
    rest = labelled_sample(rest, unlabelled).select("doc_id")
    # Both samples are of bounded size.
    p_texts = texts.join(F.broadcast(picked), "doc_id").select("text")
    u_texts = texts.join(F.broadcast(rest), "doc_id").select("text")

    def counted(frame: DataFrame, least: int) -> dict[str, int]:
        sums = frame.mapInPandas(_present, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
        return dict(sums.where(F.col("n") >= least).collect())

    n_p, n_u = p_texts.count(), u_texts.count()
    if not n_p or not n_u or not 0 < prior < 1:
        return None
    in_p = counted(p_texts, max(3, n_p // 200))
    wanted = frozenset(in_p)
    in_u = u_texts.mapInPandas(_present, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = dict(in_u.join(F.broadcast(_strings(docs, wanted)), "feature").collect()) if wanted else {}
    told = []
    for feature, n in in_p.items():
        ratio = _likelihood_ratio(n, n_p, found.get(feature, 0), n_u)
        if ratio >= evidence:
            told.append((ratio, feature))
    chosen = tuple(feature for _, feature in sorted(told, key=lambda x: (-x[0], x[1]))[:features])
    if not chosen:
        return None
    p, u = _rows(p_texts, chosen), _rows(u_texts, chosen)
    weights = [_train(p, u[i::classifiers], prior, i, steps, rate) for i in range(classifiers) if len(u[i::classifiers])]
    return ToxicityModel(chosen, np.array(weights))


def _likelihood_ratio(n_p: int, of_p: int, n_u: int, of_u: int) -> float:
    """G squared of two shares being one; 0 if the first is not the greater."""
    if n_p * of_u <= n_u * of_p:
        return 0.0
    both = (n_p + n_u) / (of_p + of_u)
    cells = ((n_p, of_p * both), (of_p - n_p, of_p * (1 - both)), (n_u, of_u * both), (of_u - n_u, of_u * (1 - both)))
    return 2 * sum(seen * np.log(seen / expected) for seen, expected in cells if seen)


def _strings(docs: DataFrame, values: frozenset[str]) -> DataFrame:
    frame = pd.DataFrame({"feature": sorted(values)})
    return docs.sparkSession.createDataFrame(frame, "feature string")


def _rows(texts: DataFrame, chosen: tuple[str, ...]) -> np.ndarray:
    """Feature rows of a bounded sample, on the driver, in an order of their own."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = _Vectors(chosen)
        for batch in batches:
            rows = vectors(batch["text"].tolist())
            yield pd.DataFrame({"row": [_pack(row) for row in rows]}, dtype=object)

    packed = sorted(bytes(r["row"]) for r in texts.mapInPandas(encode, "row binary").collect())
    out = np.zeros((len(packed), 2 * len(chosen)), np.float32)
    for i, data in enumerate(packed):
        pairs = np.frombuffer(data, [("at", "<u4"), ("value", "<f4")])
        out[i, pairs["at"]] = pairs["value"]
    return out


def _pack(row: np.ndarray) -> bytes:
    at = np.flatnonzero(row)
    pairs = np.empty(len(at), [("at", "<u4"), ("value", "<f4")])
    pairs["at"], pairs["value"] = at, row[at]
    return pairs.tobytes()


def toxicity_score(model: ToxicityModel | None, text: str | Column = "text") -> Column:
    """A column with the chance that a whole text is toxic; 0 for texts without words, or without a model."""
    text = F.col(text) if isinstance(text, str) else text

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vectors = _Vectors(model.features) if model else None
        for batch in batches:
            out = np.zeros(len(batch))
            for start in range(0, len(batch) if model else 0, 256):
                texts = batch.iloc[start : start + 256].tolist()
                found = sigmoid(model.logits(vectors(texts)))
                out[start : start + 256] = np.where([bool(t and _WORD.search(t)) for t in texts], found, 0.0)
            yield pd.Series(out)

    return F.pandas_udf(score, "double")(text.cast("string"))


def toxicity(docs: DataFrame, model: ToxicityModel | None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, score`, one row per input row; null ids and repeated rows stay, other columns are ignored.

    Nothing is shuffled. An empty table gives no rows.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), toxicity_score(model, text).alias("score"))
