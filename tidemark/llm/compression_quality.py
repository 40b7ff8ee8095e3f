"""Quality by compression: a text is like the class whose dictionary makes it smaller.

One zstandard dictionary is trained on blocks of good texts and one on blocks of bad ones. A text is
compressed block by block with each; the difference of the two sizes over their sum says which class it
resembles, and a logistic regression on other labelled texts turns it into a probability. How far the text
shrinks at all, and its length, go into the calibration too: in a text that repeats itself both
dictionaries do equally well, and in a short one the difference is noisy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.training import fit_logistic, labelled_sample, sigmoid
from tidemark.llm.worker import kept

BLOCK = 512  # bytes compressed at a time: the dictionary counts as much in a long text as in a short one
_SHARE = 32  # blocks of one text that may go into a dictionary, spread over all of it
_LEVEL = 3
_PAIRS = 4  # pairs of compressors kept


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    prior: float  # the score of every text where one class has no labels


def _dictionary(blocks: list[bytes], size: int) -> bytes:
    """A trained dictionary; of too few blocks to train on, simply the blocks."""
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:size]


def _compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    """Made once per worker process for the last few pairs of dictionaries."""
    tables = kept("compression_quality")
    found = tables.get((good, bad))
    if found is None:
        if len(tables) >= _PAIRS:
            tables.clear()
        found = tables[good, bad] = _made(good, bad)
    return found


def _made(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    out = []
    for data in (good, bad):
        dictionary = zstandard.ZstdCompressionDict(data)
        dictionary.precompute_compress(level=_LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_dict_id=False))
    return out


def _features(text: str | None, good: bytes, bad: bytes) -> tuple[float, ...]:
    data = (text or "").encode()
    sizes = [0, 0]
    for i, compressor in enumerate(_compressors(good, bad)):
        compress = compressor.compress
        sizes[i] = sum(len(compress(data[at : at + BLOCK])) for at in range(0, len(data), BLOCK))
    total = sum(sizes)
    difference = (sizes[1] - sizes[0]) / total if total else 0.0
    ratio = total / (2 * len(data)) if data else 0.0
    return difference, min(ratio, 1.0), max(0.0, 0.35 - ratio), difference * min(1.0, len(data) / 2000)


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, per_class: int = 2000, dictionary_bytes: int = 1 << 16
) -> QualityModel:
    """Trains on `docs(doc_id, text)` and `labels(doc_id, label)`, 1 for good and 0 for bad.

    At most `per_class` documents of each class are used, those of least hash; at most 32 blocks of each go
    into a dictionary. For calibration, dictionaries of either half of them measure the other half's whole
    texts; the dictionaries of the model come from both halves.
    """
    picked = labelled_sample(labels.select("doc_id", "label"), per_class)
    picked = picked.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("length(text) > 0")
    texts = texts.join(F.broadcast(picked), "doc_id").drop("doc_id")  # at most 2 * per_class rows

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, label, half in zip(batch["text"], batch["label"], batch["half"]):
                data = text.encode()
                starts = range(0, len(data), BLOCK)
                for at in starts[:: -(-len(starts) // _SHARE)]:
                    out.append((data[at : at + BLOCK], label, half))
            yield pd.DataFrame(out, columns=["block", "label", "half"])

    blocks = texts.mapInPandas(cut, "block binary, label int, half int")
    by: dict[tuple[int, int], list[bytes]] = {(label, half): [] for label in (0, 1) for half in (0, 1)}
    for row in blocks.collect():
        by[row["label"], row["half"]].append(bytes(row["block"]))
    counts = dict(picked.groupBy("label").count().collect())
    prior = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5

    def pair(*halves: int) -> list[bytes]:
        found = [sorted({b for half in halves for b in by[label, half]}) for label in (1, 0)]
        return [_dictionary(each, dictionary_bytes) if each else b"" for each in found]

    good, bad = pair(0, 1)
    if not good or not bad:
        return QualityModel(b"", b"", (), prior)
    across = [pair(1), pair(0)]  # what measures half 0, and half 1

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns = (batch[c] for c in ("text", "label", "half"))
            rows = [(*_features(text, *across[half]), label) for text, label, half in zip(*columns) if all(across[half])]
            yield pd.DataFrame(rows, columns=["a", "b", "c", "d", "label"])

    schema = "a double, b double, c double, d double, label int"
    held = np.array(texts.mapInPandas(measure, schema).collect(), float).reshape(-1, 5)
    if len(set(held[:, -1])) < 2:
        return QualityModel(good, bad, (20.0, 0.0, 0.0, 0.0, 0.0), prior)
    held = held[np.lexsort(held.T)]
    return QualityModel(good, bad, tuple(fit_logistic(held[:, :-1], held[:, -1])), prior)


def quality_score(model: QualityModel, text: str | Column = "text") -> Column:
    """A column with the probability that a whole text is good; 0 for null and empty texts."""
    text = F.col(text) if isinstance(text, str) else text
    good, bad, weights, prior = model.good, model.bad, np.array(model.weights), model.prior

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if not len(weights):
                yield pd.Series([prior if t else 0.0 for t in batch], dtype=float)
                continue
            rows = np.array([_features(t, good, bad) for t in batch], float).reshape(-1, 4)
            found = sigmoid(rows @ weights[:-1] + weights[-1])
            yield pd.Series(np.where([bool(t) for t in batch], found, 0.0))

    return F.pandas_udf(score, "double")(text.cast("string"))


def quality(docs: DataFrame, model: QualityModel, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, score`, one row per input row; null ids and repeated rows stay, other columns are ignored.

    Nothing is shuffled. An empty table gives no rows.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), quality_score(model, text).alias("score"))
