"""Near-duplicate documents by consistent weighted sampling of TF-IDF shingles.

A document is a weighted set: its shingles of five words, each with its count times its idf. Improved
consistent weighted sampling draws from such a set so that two documents draw the same with a chance of
exactly their weighted Jaccard similarity. Draws are grouped into bands; documents that agree on a band
are candidates.

The idf of the draws is 1 + log((1 + N) / (1 + df)), of every shingle: passages that many documents have are
seldom drawn and bring few candidates. The document frequencies are counted in a fixed number of cells, twice,
by the first and by the last bits of a shingle's hash; the lesser cell counts. It is exact unless others
share both cells, and too high by about one document in `cells / shingles of a document` at worst, so nothing but
the cells goes through a shuffle, however large the table.

Candidates are linked if the weighted Jaccard similarity of their whole texts reaches the threshold. There the
idf is log(N / df) / log(1 / common), 1 for shingles in less than a share `common` of all
documents, and no less than 0.99: what links two texts must not depend on how many others have them. A large group
of copies makes its own text common; with the idf of the draws, the few words that
a copy changes would weigh far above the text it shares, and the group would come apart. There are at most
`1 / common` times as many common shingles as shingles in a mean document, so they can be broadcast, and they
are found without sending all shingles through a shuffle: a shingle that common is nearly as common in
some block of documents. The idf of the draws makes the members of a large group less alike (at 0.8 with all shared text
in a twentieth of 50,000 documents 0.6, at 0.8 with text of two documents 0.79); bands of two draws, not three, keep those pairs.

Equal texts are merged before any comparison. A band's documents are compared with three of them, not with
each other: those that meet most others in all their bands, as the common original of a group of copies
does. In bands of more than four, those outside the classes so found are compared with others, while that
links enough of them. What such bands still hold of different classes is then joined exactly: two texts that reach
the threshold share a shingle among the rarest of both, so all pairs that do are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bitmap import Bitmap, filter_of
from tidemark.llm.components import components
from tidemark.llm.shingles import WordHashes, mixed, mixed_pairs, shingles, words
from tidemark.llm.tables import saved, temporary, without_rows

_BLOCK = 1 << 21  # shingles counted at a time when common ones are sought
_LEAST_IDF = 0.99  # links at a weighted 0.8 all pairs that are at 0.802 unweighted, however common their text
_ROWS = 2048  # shingles drawn from at a time
_HELD = 1 << 16  # shingles of texts that are drawn from together
_LOW = np.uint64(0xFFFF)
_B_SCALE = np.float32(1 / 65536)
_CENTRES = 3  # members of a band that all others are compared with in the first turn
_CELL_BITS = 20  # document frequencies are counted in 2 ** 20 cells, twice
_CHUNK = 1 << 13  # cells in one row
_LEVELS = (2, 8, 64, 512, 4096)  # occurrences from which a shingle comes later in the order
_WORTH = 0.05  # links per pair compared below which another turn is not worth its pairs


def _document_shingles(table: WordHashes, found: list[bytes], size: int) -> np.ndarray:
    """All shingles of a text's words; fewer words are one shingle."""
    hashes = table.of(found)
    return shingles(hashes, min(size, len(hashes))) if len(hashes) else np.empty(0, np.uint64)


class Frequencies:
    """Idf of all shingles, 1 + log((1 + N) / (1 + df)), from document frequencies counted in cells."""

    def __init__(self, total: int, cells: np.ndarray) -> None:
        self.cells = (1 + np.log((1 + total) / (1 + np.minimum(cells, total)))).astype(np.float32)

    @staticmethod
    def cells_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each hash's cell by its first bits, and by its last."""
        last = hashes & np.uint64((1 << _CELL_BITS) - 1)
        return (hashes >> np.uint64(64 - _CELL_BITS)).astype(np.int64), last.astype(np.int64) + (1 << _CELL_BITS)

    def idf(self, hashes: np.ndarray) -> np.ndarray:
        first, last = self.cells_of(hashes)
        return np.maximum(self.cells[first], self.cells[last])


def _packed(counts: np.ndarray) -> bytes:
    """All first bytes, then all second bytes …: small counts compress to little."""
    return counts.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _added(cells: pd.Series) -> bytes:
    return _packed(sum(map(_unpacked, cells)))


def frequencies(docs: DataFrame, size: int, share: float) -> tuple[tuple[np.ndarray, np.ndarray], Frequencies]:
    """Hashes (in order) and idf of the shingles in at least a share of all documents, and the idf of all."""

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of documents report what at least share / 4 of them have; a task counts all in cells."""
        table, block, held = WordHashes(), [], 0
        cells = np.zeros(2 << _CELL_BITS, np.int64)

        def found() -> pd.DataFrame:
            every = np.concatenate(block)
            for at in Frequencies.cells_of(every):
                np.add.at(cells, at, 1)
            each, n = np.unique(every, return_counts=True)
            often = n >= share / 4 * len(block)
            return pd.DataFrame({"hash": each[often].view(np.int64), "n": n[often], "docs": len(block), "cells": None})

        for batch in batches:
            for text in batch["text"]:
                block.append(np.unique(_document_shingles(table, words(text), size)))
                held += len(block[-1])
                if held >= _BLOCK:
                    yield found()
                    block, held = [], 0
        if block:
            yield found()
        parts = cells.reshape(-1, _CHUNK)
        used = np.flatnonzero(parts.any(axis=1))
        for at in np.array_split(used, -(-len(used) // 16)) if len(used) else ():
            yield pd.DataFrame({"hash": at, "n": 0, "docs": 0, "cells": [_packed(parts[i]) for i in at]})

    total = docs.count()
    cells = np.zeros(((2 << _CELL_BITS) // _CHUNK, _CHUNK), np.int64)
    added = F.pandas_udf(_added, "binary")("cells").alias("cells")
    with temporary() as for_now:
        reported = for_now(docs.mapInPandas(report, "hash long, n long, docs long, cells binary"), "reported")
        for row in reported.where("cells is not null").groupBy("hash").agg(added).collect():
            cells[row["hash"]] = _unpacked(row["cells"])
        # A block that is silent has less than share / 4; with that added, all that may reach the share stay.
        # Each of them is in three quarters of the share of all documents, which bounds their number.
        sums = reported.where("cells is null").groupBy("hash").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        may = sums.where(F.col("n") + share / 4 * (total - F.col("docs")) >= share * total).collect()
    every = Frequencies(total, cells.reshape(-1))
    if all(row["docs"] == total for row in may):  # no block was silent on any: the sums are the counts
        return _idf([row for row in may if row["n"] >= share * total], total, share), every
    maybe = np.array(sorted(row["hash"] for row in may), np.int64)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, n = WordHashes(), np.zeros(len(maybe), np.int64)
        for batch in batches:
            for text in batch["text"]:
                own = np.unique(_document_shingles(table, words(text), size)).view(np.int64)
                at = np.searchsorted(maybe, own)
                at[at == len(maybe)] = 0
                n[at[maybe[at] == own]] += 1
        yield pd.DataFrame({"hash": maybe, "n": n})

    exact = docs.mapInPandas(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return _idf(exact.where(F.col("n") >= share * total).collect(), total, share), every


def common_shingles(docs: DataFrame, size: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (in order) and idf of the shingles in at least a share of all documents."""
    return frequencies(docs, size, share)[0]


def _idf(rows: list, total: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.array([row["hash"] for row in rows], np.int64).view(np.uint64)
    idf = np.log(total / np.array([row["n"] for row in rows], float)) / np.log(1 / share)
    order = np.argsort(hashes)
    return hashes[order], idf[order]


class Weigher:
    """Words of texts to weighted sets: distinct shingles in order, and count times idf."""

    def __init__(self, size: int, common: tuple[np.ndarray, np.ndarray]) -> None:
        self.size, self.hashes, self.idf = size, *common
        self.table = WordHashes()

    def __call__(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        own, n = np.unique(_document_shingles(self.table, found, self.size), return_counts=True)
        weights = n.astype(float)
        if len(self.hashes) and len(own):
            at = np.searchsorted(self.hashes, own)
            at[at == len(self.hashes)] = 0
            weights *= np.where(self.hashes[at] == own, np.maximum(self.idf[at], _LEAST_IDF), 1.0)
        return own, weights


def tf_idf(table: WordHashes, found: list[bytes], size: int, every: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in order, and what the draws weigh them by: count times idf."""
    own, n = np.unique(_document_shingles(table, found, size), return_counts=True)
    return own, n * every.idf(own)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    union = a[1].sum() + b[1].sum() - shared
    return float(shared / union) if union else 0.0


class Sampler:
    """Improved consistent weighted sampling, `draws` draws per weighted set.

    Each shingle and draw has its own r and c from Gamma(2, 1) and b from (0, 1), all three read from one
    hash. With t = floor(ln w / r + b) the least of ln c - r (t + 1 - b) wins, and (shingle, t) is drawn.
    """

    def __init__(self, draws: int) -> None:
        self.seeds = mixed(np.arange(1, draws + 1, dtype=np.uint64))
        # Quantiles of Gamma(2, 1): its distribution function is 1 - (1 + x) exp(-x).
        x = np.concatenate([np.linspace(0, 30, 3_000_000), [60.0]])
        at = (np.arange(1 << 16) + 0.5) / (1 << 16)
        self.gamma = np.interp(at, -np.expm1(-x + np.log1p(x)), x).astype(np.float32)
        self.log_gamma = np.log(self.gamma)
        # Work space, so that a block stays in the processor's cache; one row per draw.
        self.whole = [np.empty(draws * _ROWS, np.uint64) for _ in range(3)]
        self.real = [np.empty(draws * _ROWS, np.float32) for _ in range(5)]

    def __call__(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return self.of_all([(hashes, weights)])[0]

    def of_all(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The draws of each weighted set, a row per set. Blocks go across sets."""
        hashes = np.concatenate([own for own, _ in sets])
        logs = np.log(np.concatenate([weights for _, weights in sets])).astype(np.float32)
        ends = np.cumsum([len(own) for own, _ in sets])
        best = np.full((len(sets), len(self.seeds)), np.inf, np.float32)
        drawn = np.zeros((len(sets), len(self.seeds)), np.uint64)
        each = np.arange(len(self.seeds))
        for start in range(0, len(hashes), _ROWS):
            own = hashes[start : start + _ROWS]
            t, value = self._values(own, logs[start : start + _ROWS])
            # The sets that this block holds, or a part of them.
            first, last = np.searchsorted(ends, (start, start + len(own) - 1), "right")
            cuts = np.clip(ends[first : last + 1] - start, 0, len(own)).tolist()
            at = np.empty((len(cuts), len(each)), np.intp)
            begin = 0
            for i, cut in enumerate(cuts):
                if begin < cut:
                    np.add(value[:, begin:cut].argmin(axis=1), begin, out=at[i])
                else:  # an empty set
                    at[i] = -1
                begin = cut
            least = np.where(at < 0, np.float32(np.inf), value[each, at])
            better = least < best[first : last + 1]
            level = t[each, at].astype(np.int64).view(np.uint64)
            np.copyto(best[first : last + 1], least, where=better)
            np.copyto(drawn[first : last + 1], mixed(own[at] ^ mixed(level + np.uint64(1))), where=better)
        return drawn

    def _values(self, own: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """t and the value to be least, for each draw (row) and shingle."""
        shape = (len(self.seeds), len(own))
        size = len(self.seeds) * len(own)
        bits, spare, part = (space[:size].reshape(shape) for space in self.whole)
        r, b, t, after, value = (space[:size].reshape(shape) for space in self.real)
        mixed_pairs(self.seeds, own, bits, spare)
        np.bitwise_and(bits, _LOW, out=part)
        np.take(self.gamma, part.view(np.int64), out=r, mode="clip")
        np.right_shift(bits, np.uint64(16), out=spare)
        np.bitwise_and(spare, _LOW, out=part)
        np.take(self.log_gamma, part.view(np.int64), out=value, mode="clip")
        np.right_shift(bits, np.uint64(32), out=spare)
        np.bitwise_and(spare, _LOW, out=part)
        np.copyto(b, part, casting="unsafe")
        np.multiply(b, _B_SCALE, out=b)
        np.divide(logs, r, out=t)
        np.add(t, b, out=t)
        np.floor(t, out=t)
        np.add(t, np.float32(1), out=after)
        np.subtract(after, b, out=after)
        np.multiply(r, after, out=after)
        np.subtract(value, after, out=value)
        return t, value


def _sketcher(size: int, every: Frequencies, bands: int, rows: int) -> Callable:
    def sketch(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table, sample = WordHashes(), Sampler(bands * rows)
        seeds = np.arange(1, bands + 1, dtype=np.uint64)

        def keys_of(sets: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
            drawn = sample.of_all(sets).reshape(len(sets), bands, rows)
            value = np.broadcast_to(seeds, (len(sets), bands))
            for i in range(rows):
                value = mixed(value ^ drawn[:, :, i])
            return list(value.view(np.int64))

        for batch in texts:
            digests, keys, sets, held = [], [], [], 0
            places = []  # of the texts whose sets are held
            for text in batch:
                found = words(text)
                if not found:
                    digests.append(None)
                    keys.append([])
                    continue
                digests.append(blake2b(b" ".join(found), digest_size=16).digest())
                sets.append(tf_idf(table, found, size, every))
                places.append(len(keys))
                keys.append(None)
                held += len(sets[-1][0])
                if held >= _HELD:
                    for at, value in zip(places, keys_of(sets)):
                        keys[at] = value
                    sets, places, held = [], [], 0
            if sets:
                for at, value in zip(places, keys_of(sets)):
                    keys[at] = value
            yield pd.DataFrame({"digest": digests, "bands": keys})

    return F.pandas_udf(sketch, "digest binary, bands array<long>")


def _similarity(size: int, common) -> Callable:
    def compare(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        weigh = Weigher(size, common)
        for lefts, rights in batches:
            last, left = None, None
            out = []
            for a, b in zip(lefts, rights):
                if a != last:
                    last, left = a, weigh(words(a))
                out.append(weighted_jaccard(left, weigh(words(b))))
            yield pd.Series(out, dtype=float)

    return F.pandas_udf(compare, "double")


def classes(
    docs: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = 5,
    threshold: float = 0.8,
    bands: int = 18,
    rows: int = 2,
    common: float = 0.1,
) -> DataFrame:
    """`doc` (all columns of the input in one), `class_id`, `class_size`, `kept`, one row per input row.

    Texts of the same words are one class, and so are all that links join: pairs that agree on a band and
    whose weighted Jaccard similarity is at least `threshold`. At a TF-IDF similarity of 0.5, 18 bands of 2 draws
    miss 6 in 1,000 pairs, at 0.6 3 in 10,000. `class_id` is the least id in the class, nulls aside; `kept` holds for the one row of
    the class with that id (the first read, if the id is repeated). Texts shorter than `size` words are
    one shingle. Null texts, and others without words, are never duplicates: each is a class with its own
    id. An empty table gives no rows.
    """
    held, groups = _groups(docs, saved, text, doc_id, size, threshold, bands, rows, common)
    found = held.select("doc", "row", "digest").join(groups, "digest", "left")
    alone = F.col("digest").isNull()
    return found.select(
        "doc",
        F.when(alone, F.col(f"doc.`{doc_id}`")).otherwise(F.col("kept.id")).alias("class_id"),
        F.when(alone, F.lit(1).cast("long")).otherwise(F.col("size")).alias("class_size"),
        (alone | (F.col("row") == F.col("kept.row"))).alias("kept"),
    )


def _groups(
    docs: DataFrame,
    saved_groups: Callable[[DataFrame, str], DataFrame],
    text: str = "text",
    doc_id: str = "doc_id",
    size: int = 5,
    threshold: float = 0.8,
    bands: int = 18,
    rows: int = 2,
    common: float = 0.1,
) -> tuple[DataFrame, DataFrame]:
    """`doc, digest, row` of every row, and per digest `kept` (the row that stays of its class) and `size`.

    `saved_groups` saves what the second reads.
    """
    texts = docs.select(F.col(text).cast("string").alias("text"))
    frequent, every = frequencies(texts, size, common)
    sketch = _sketcher(size, every, bands, rows)(F.col(text).cast("string"))
    held = docs.select(F.struct("*").alias("doc"), sketch.alias("sketch"))
    held = held.select("doc", "sketch.*", F.monotonically_increasing_id().alias("row"))
    held = saved(held, "sketches")

    own = F.struct(F.col(f"doc.`{doc_id}`").isNull().alias("none"), F.col(f"doc.`{doc_id}`").alias("id"), "row")
    nodes = held.where("digest is not null").groupBy("digest")
    nodes = nodes.agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"), F.min("row").alias("node"))
    nodes = saved_groups(nodes, "texts")
    texts = held.select(F.col("row").alias("node"), F.col(f"doc.`{text}`").cast("string").alias("text"))
    with temporary() as for_now:
        labels = saved_groups(_labels(nodes, texts, for_now, size, frequent, threshold), "classes")

    named = nodes.select("digest", "node", "first", "n").join(labels, "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    whole = named.groupBy("label").agg(F.min("first").alias("kept"), F.sum("n").alias("size"))
    return held, named.select("digest", "label").join(whole, "label").select("digest", "kept", "size")


def _labels(
    nodes: DataFrame, texts: DataFrame, for_now: Callable[[DataFrame, str], DataFrame], size: int, common, threshold: float
) -> DataFrame:
    """`node, label` of all of `nodes(node, bands)` that are linked; `texts(node, text)` may hold more."""
    keys = nodes.select("node", F.explode("bands").alias("band"))
    buckets = keys.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = for_now(keys.join(buckets, "band"), "members")
    # How many others a node meets in all its bands: most where a group of copies has its common original.
    met = members.groupBy("node").agg(F.sum("n").alias("met"))
    members = for_now(members.join(met, "node"), "ranked_members")
    large = members.where(F.col("n") > _CENTRES + 1)  # in smaller bands, the first turn compares all with all
    # A bitmap drops most texts before the shuffle, the join the few that it lets through.
    texts = texts.where(filter_of(met.select("node"))("node")).join(met.select("node").hint("merge"), "node", "left_semi")
    texts = for_now(texts, "member_texts")

    def scores(pairs: DataFrame) -> DataFrame:
        """Only texts that a bitmap of the pairs lets through are shuffled. They are, even if a broadcast would do: a
        task that filtered and compared would run two Python workers, and an executor keep twice as many."""
        pairs = for_now(pairs, "pairs")
        with_texts = pairs
        for name in "ab":
            needed = texts.where(filter_of(pairs.select(name))("node"))
            needed = needed.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))
            with_texts = with_texts.join(needed.hint("merge"), name)
        score = _similarity(size, common)("text_a", "text_b")
        return for_now(with_texts.select("a", "b", score.alias("score")), "scored")

    labels = tried = None
    turn = 0
    while True:
        scored = scores(_pairs(members, turn, _CENTRES) if labels is None else _pairs(large, turn, 1, labels, tried))
        near = scored.where(F.col("score") >= threshold).select("a", "b")
        tried = scored.select("a", "b") if tried is None else tried.unionByName(scored.select("a", "b"))
        linked = near.count()
        if labels is not None:
            if not linked:
                break
            # The stars of the classes so far stand for the links before.
            near = near.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
        labels = for_now(components(near, for_now), "labels")
        # Few links would cost a turn each, more turns the more documents there are; they are left to the prefixes.
        if turn and linked < _WORTH * scored.count():
            break
        turn += 1

    # Turns can miss a pair: all that large bands still hold apart is joined by prefixes, which cannot.
    apart = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed_bands = apart.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    apart = for_now(apart.join(mixed_bands, "band").select("node", "label").distinct(), "apart")
    if not apart.isEmpty():
        pairs = _prefix_pairs(apart.join(texts, "node"), size, common, threshold, for_now).join(tried, ["a", "b"], "left_anti")
        near = scores(pairs).where(F.col("score") >= threshold).select("a", "b")
        near = near.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
        labels = components(near, for_now)
    return labels


def _pairs(
    members: DataFrame, turn: int, centres: int, labels: DataFrame | None = None, tried: DataFrame | None = None
) -> DataFrame:
    """Each member of a band with the band's centres.

    In the first turn these are the members that meet most others in all their bands. Later, with labels,
    they are drawn by a hash of turn, band and node: a member left over meets other members in every band.
    Members of a centre's class are then left out, and so are pairs tried before.
    """
    members = members.select("band", "node", "met")
    if labels is None:
        members = members.withColumn("label", F.col("node"))
    else:
        members = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    order = F.desc("met") if labels is None else F.xxhash64(F.lit(turn), "band", "node")
    first = Window.partitionBy("band").orderBy(order, "node")
    chosen = members.withColumn("place", F.row_number().over(first)).where(F.col("place") <= centres)
    chosen = chosen.select("band", F.col("node").alias("centre"), F.col("label").alias("centre_label"))
    pairs = members.select("band", "node", "label").join(chosen, "band").where("label <> centre_label")
    pairs = pairs.select(F.greatest("centre", "node").alias("b"), F.least("centre", "node").alias("a")).distinct()
    return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")


def _prefix_pairs(
    texts: DataFrame, size: int, common, threshold: float, saved: Callable[[DataFrame, str], DataFrame] = saved
) -> DataFrame:
    """`a, b`: all pairs of `texts(node, label, text)` of different labels that can reach the threshold.

    Shingles have one order: those of one text first, then by how often they occur, in steps, then by hash.
    At the first shingle that a pair at the threshold shares, what is left of both texts weighs at least
    the share of their weights that they must have in common. A text's weight and what is left so tell how heavy
    a partner may be; one of the two must allow a partner as heavy as itself. Shingles that only
    one text has count in the weights, but are never written.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh, block, held = Weigher(size, common), [], 0

        def counted() -> pa.RecordBatch:
            each, n = np.unique(np.concatenate(block), return_counts=True)
            return pa.record_batch([pa.array(each.view(np.int64)), pa.array(n)], names=["hash", "n"])

        for batch in batches:
            for text in batch.column(0):
                block.append(weigh(words(text.as_py()))[0])
                held += len(block[-1])
                if held >= _BLOCK:
                    yield counted()
                    block, held = [], 0
        if block:
            yield counted()

    counts = texts.select("text").mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    counts = saved(counts.where("n > 1"), "shared_shingles")
    levels = [Bitmap.of(counts.where(F.col("n") >= least).select("hash")) for least in _LEVELS]
    share = threshold / (1 + threshold)
    least = 1 - 1e-6  # for rounding

    def prefixes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weigh = Weigher(size, common)
        for batch in batches:
            out = []
            for text in batch:
                hashes, weights = weigh(words(text))
                level = np.zeros(len(hashes), np.int8)
                for bitmap in levels:
                    level += bitmap.has(hashes)
                order = np.lexsort((hashes, level))
                rest = np.cumsum(weights[order][::-1])[::-1]
                early = (level[order] > 0) & (rest >= threshold * rest[0] * least)
                out.append((hashes[order][early].view(np.int64), rest[early], rest[0]))
            yield pd.DataFrame(out, columns=["keys", "rests", "total"])

    udf = F.pandas_udf(prefixes, "keys array<long>, rests array<double>, total double")
    keys = texts.select("node", "label", udf("text").alias("own")).select("node", "label", "own.total", F.explode(F.arrays_zip("own.keys", "own.rests")).alias("at"))
    # The heaviest partner that shares this shingle as the first.
    allows = (F.col("at.rests") / share / least - F.col("total")).alias("allows")
    keys = saved(keys.select("node", "label", "total", F.col("at.keys").alias("key"), allows), "prefixes")
    # Where a key is all of one class nothing is compared; else all outside its largest class with all others.
    own = F.count_if(F.col("allows") >= F.col("total"))
    classes_of = keys.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), own.alias("wide"))
    meeting = classes_of.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("wide").alias("wide"), F.max_by("label", "n").alias("main"))
    keys = saved(keys.join(meeting.where("n > 1 and wide > 0").select("key", "main"), "key"), "meeting_prefixes")
    named = [F.col(name).alias(f"one_{name}") for name in ("node", "label", "total", "allows")]
    wide = keys.where("allows >= total").select("key", "main", *named)
    fits = F.expr("label <> one_label and total <= one_allows and one_total <= allows")
    pairs = wide.where("one_label <> main").join(keys.drop("main"), "key").where(fits).select("node", "one_node")
    pairs = pairs.unionByName(
        wide.where("one_label = main").join(keys.where("label <> main").drop("main"), "key").where(fits).select("node", "one_node")
    )
    return pairs.select(F.least("one_node", "node").alias("a"), F.greatest("one_node", "node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """`doc_id, class_id, class_size, kept` per row; see `classes` for options and odd rows."""
    found = classes(docs, doc_id=doc_id, **options)
    return found.select(F.col(f"doc.`{doc_id}`").alias("doc_id"), "class_id", "class_size", "kept")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay, one per class, with all their columns."""
    with temporary() as for_now:
        held, groups = _groups(docs, for_now, **options)
        copies = held.select("row", "digest").join(groups, "digest").where("row <> kept.row").select("row")
        copies = saved(copies, "copies")
    return without_rows(held, copies).select("doc.*")
