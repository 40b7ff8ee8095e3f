"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is a set of windows, each a run of `window` words. A document holds a window only if it
holds all of the window's shingles, so any one of them is a necessary prefix; the rarest in the corpus is
taken, which sends the fewest document positions into the join. The place of the shingle in the window
and the document's length say where the window would have to lie; only if that is inside the document are
the words compared, one by one.

Documents are read twice: to count the shingles that items have, and to find the places of the chosen
ones. Both passes drop positions by a bitmap of fixed size, so nothing that grows with the benchmark is
broadcast: a larger benchmark only makes the bitmap let more positions through to the join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shingles import WordHashes, shingles, words
from tidemark.llm.tables import saved, temporary, without_rows

_BITS = 24  # the bitmap has 2 ** 24 bits, 2 MB
_WINDOWS = "item_id string, window string, n int, size int, hashes array<long>"
_PLACES = "place int, hash long, first int, near array<string>"


def item_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """`item_id, window, n, size, hashes`: the words of each window in one string, their number, and the
    hashes of its shingles of `size` words in order. An item without words has no window."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = WordHashes()
        for batch in batches:
            out = []
            for item, text in zip(batch["item_id"], batch["text"]):
                found = words(text)
                n = min(window, len(found))
                if not n:
                    continue
                size = min(shingle, n)
                hashes = shingles(table.of(found), size).view(np.int64)
                for i in range(len(found) - n + 1):
                    run = b" ".join(found[i : i + n]).decode()
                    out.append((item, run, n, size, hashes[i : i + n - size + 1].tolist()))
            yield pd.DataFrame(out, columns=["item_id", "window", "n", "size", "hashes"])

    return items.mapInPandas(cut, _WINDOWS)


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Which upper bits occur in the column `hash`: at most 2 ** 18 rows of 64 bits reach the driver."""
    at = F.shiftrightunsigned("hash", 64 - _BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - _BITS}) & 63 as int))")
    rows = hashes.select(F.shiftright(at, 6).alias("word"), bit.alias("bit"))
    out = np.zeros(1 << (_BITS - 6), np.int64)
    for word, bits in rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        out[word] = bits
    return out.view(np.uint64)


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - _BITS)
    return np.flatnonzero(bitmap[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1))


def _counter(bitmap: np.ndarray, sizes: list[int]) -> Callable:
    """Occurrences per batch of the shingles that the bitmap holds."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = WordHashes()
        for batch in batches:
            found = []
            for text in batch["text"]:
                hashes = table.of(words(text))
                for size in sizes:
                    own = shingles(hashes, size)
                    found.append(own[_in_bitmap(bitmap, own)])
            each, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), [])
            yield pd.DataFrame({"hash": each.view(np.int64), "n": np.asarray(n, np.int64)})

    return count


def _finder(bitmap: np.ndarray, sizes: list[int], reach: int) -> Callable:
    """Per document the places of shingles that the bitmap holds, each with the words around it."""

    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = WordHashes()
        for batch in texts:
            counts, places = [], []
            for text in batch:
                found = words(text)
                hashes = table.of(found)
                own = []
                for size in sizes:
                    each = shingles(hashes, size)
                    for place in _in_bitmap(bitmap, each).tolist():
                        first = max(0, place + size - reach)
                        near = [word.decode() for word in found[first : place + reach]]
                        own.append({"place": place, "hash": each[place].astype(np.int64), "first": first, "near": near})
                counts.append(len(found))
                places.append(own)
            yield pd.DataFrame({"n_words": counts, "places": places})

    return find


def _union_length(runs: Column) -> Column:
    """Words covered by sorted (start, end) runs."""
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("last"))

    def add(acc: Column, run: Column) -> Column:
        new = F.greatest(run["end"] - F.greatest(run["start"], acc["last"]), F.lit(0))
        return F.struct((acc["covered"] + new).alias("covered"), F.greatest(acc["last"], run["end"]).alias("last"))

    return F.aggregate(runs, start, add, lambda acc: acc["covered"])


def contamination(docs: DataFrame, items: DataFrame, **options: int) -> DataFrame:
    """How much of each document is benchmark text.

    `docs` has `doc_id, text`, `items` has `item_id, text`; other columns are ignored. A word is hit if it
    lies in an occurrence of a window: `window` consecutive words of an item, or all of a shorter item.
    One row per row of `docs`: `doc_id, n_words, n_hit, item_ids` (strings, sorted; items with an
    occurring window). Rows are told apart even if ids repeat or are null. Null and empty texts have no
    words; items without words or id match nothing; either table may be empty.
    """
    found, windows, hits = _hits(docs, items, ["doc_id"], saved, **options)
    named = hits.select("row", "window").distinct().join(windows.select("window", "item_id"), "window")
    named = named.groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    return (
        found.select("row", "doc.doc_id", "n_words")
        .join(_covered(hits).drop("n_words"), "row", "left")
        .join(named, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )


def clean_documents(docs: DataFrame, items: DataFrame, *, one_in: int = 20, **options: int) -> DataFrame:
    """The rows of `docs`, with all their columns, of which less than one word in `one_in` is hit."""
    with temporary() as for_now:
        found, _, hits = _hits(docs, items, docs.columns, for_now, **options)
        contaminated = saved(_covered(hits).where(is_contaminated(one_in)).select("row"), "contaminated")
    return without_rows(found, contaminated).select("doc.*")


def _covered(hits: DataFrame) -> DataFrame:
    """`row, n_hit, n_words` of documents with hits; `n_hit` counts the words that lie in any."""
    runs = F.sort_array(F.collect_set(F.struct("start", "end")))
    return hits.groupBy("row").agg(_union_length(runs).cast("long").alias("n_hit"), F.first("n_words").alias("n_words"))


def _hits(
    docs: DataFrame,
    items: DataFrame,
    carried: list[str],
    saved_hits: Callable[[DataFrame, str], DataFrame],
    *,
    window: int = 13,
    shingle: int = 3,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`row, doc` (the columns carried along), `n_words`; `window, item_id, …` of items; `row, start, end, window, n_words`
    of their windows in documents. `saved_hits` saves the last two."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    own = items.where(F.col("item_id").isNotNull())
    own = own.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    windows = saved_hits(item_windows(own, window, shingle), "item_windows")
    sizes = sorted(row["size"] for row in windows.select("size").distinct().collect())  # of 1 to `shingle`

    # The rarest shingle of each different window. One that no document has rules the window out.
    each = windows.dropDuplicates(["window"])
    parts = each.select("window", "n", F.posexplode("hashes").alias("offset", "hash"))
    held = _bitmap(parts)
    counts = texts.mapInPandas(_counter(held, sizes), "hash long, n long")
    counts = counts.groupBy("hash").agg(F.sum("n").alias("corpus"))
    prefixes = parts.join(counts, "hash", "left").groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("corpus", F.lit(0)).alias("corpus"), "hash", "offset")).alias("rarest")
    )
    prefixes = prefixes.where("rarest.corpus > 0").select("window", "n", "rarest.hash", "rarest.offset")
    prefixes = saved_hits(prefixes, "prefixes")

    finder = F.pandas_udf(_finder(_bitmap(prefixes), sizes, window), f"n_words long, places array<struct<{_PLACES}>>")
    found = docs.select(F.struct(*(F.col(f"`{name}`") for name in carried)).alias("doc"), finder(F.col("text").cast("string")).alias("found"))
    found = saved(found.select("doc", "found.*", F.monotonically_increasing_id().alias("row")), "places")

    places = found.where(F.size("places") > 0).select("row", "n_words", F.inline("places"))
    start = F.col("place") - F.col("offset")
    inside = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    same = F.array_join(F.slice("near", start - F.col("first") + 1, F.col("n")), " ") == F.col("window")
    hits = places.join(prefixes, "hash").where(F.when(inside, same))
    hits = hits.select("row", start.alias("start"), (start + F.col("n")).alias("end"), "window", "n_words")
    return found.select("row", "doc", "n_words"), windows, saved_hits(hits, "hits")


def is_contaminated(one_in: int = 20) -> Column:
    """At least one word in `one_in` is hit."""
    return (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))
