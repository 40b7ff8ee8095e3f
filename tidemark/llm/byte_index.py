"""Near-duplicate documents by 64-bit SimHash fingerprints and an inverted index on byte positions.

A fingerprint has eight bytes. Two that differ in at most three bits differ in at most three bytes, so at
least five of their bytes are equal in the same place. Counting equal bytes over the lists of single bytes
would meet nearly all pairs (there are 2,048 lists, whatever the corpus), so the index keeps lists for
four positions at a time: for the 14 sets of four positions whose numbers have exclusive-or zero. Any
three positions lie in one of these sets, and the other four positions are a set as well; so a pair with
five equal bytes shares at least one list. In a list, the equal bytes of each pair are tallied, pairs with
fewer than five are dropped and the others verified bit by bit.

Equal fingerprints are one entry. A list that is too long to compare in one task is split again: its free
bits fall into four blocks, one of which a pair must agree on. Splits go on until lists are short; they
come to an end, as a list whose ten free bits or fewer can be anything has 1,024 entries at most. So no
pair is lost, however many fingerprints crowd together. A list gives no more links than it has entries:
those that hold together what its pairs connect.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.tables import saved

WORDS, SEED = 3, 42  # words in a shingle, seed of its hash
BITS = 3  # fingerprints link at up to so many differing bits
_LEAST_BYTES = 8 - BITS  # equal bytes that this leaves at least
_LIST = 2048  # entries of a list that are compared in one task
_ROWS = 256  # entries compared with all others of a list at a time
_HASHES = 1 << 16  # shingles of a text counted at a time
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("mask", pa.int64())])


def fingerprint(text: bytes | None) -> int:
    """SimHash of a text in UTF-8: a bit is set if it is in over half of the shingles' hashes."""
    found = text.lower().split() if text else []  # bytes: A-Z only, and the six white-space characters of ASCII
    if not found:
        return 0
    size = min(WORDS, len(found))
    joined = b" ".join(found)
    ends = list(accumulate(len(word) + 1 for word in found))
    starts = [0, *ends]
    count = len(found) - size + 1
    ones = np.zeros(64, np.int64)
    for first in range(0, count, _HASHES):
        last = min(first + _HASHES, count)
        hashes = [
            xxhash.xxh64_intdigest(joined[s : e - 1], SEED)
            for s, e in zip(starts[first:last], ends[first + size - 1 : last + size - 1])
        ]
        ones += np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count).view(">u8")[0])


def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series(np.array([fingerprint(text) for text in batch], np.uint64).view(np.int64))


def position_masks() -> list[int]:
    """Masks of the 14 sets of four byte positions."""
    sets = [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
    return [sum(0xFF << 8 * position for position in s) for s in sets]


def split_masks(mask: int) -> list[int]:
    """The mask with each of four blocks of the bits that it leaves free."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    blocks = np.array_split(free, BITS + 1)
    return [mask | sum(1 << int(bit) for bit in block) for block in blocks if len(block)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def connect(entries: np.ndarray) -> list[tuple[int, int]]:
    """Links (as places) that join what pairs of a list's entries connect: each entry with the first of its own."""
    n = len(entries)
    near = np.zeros((n, n), bool)
    for first in range(0, n, _ROWS):
        differ = entries[first : first + _ROWS, None] ^ entries[None, :]
        tally = (differ.view(np.uint8).reshape(-1, n, 8) == 0).sum(axis=2, dtype=np.uint8)
        row, column = np.nonzero(tally >= _LEAST_BYTES)
        close = np.bitwise_count(differ[row, column]) <= BITS
        near[first + row[close], column[close]] = True
    out, alone = [], np.ones(n, bool)
    for start in range(n):
        if alone[start]:
            reached = np.zeros(n, bool)
            frontier = np.array([start])
            while len(frontier):
                reached[frontier] = True
                frontier = np.flatnonzero(near[frontier].any(axis=0) & ~reached)
            alone &= ~reached
            out += [(int(other), start) for other in np.flatnonzero(reached) if other != start]
    return out


def _compare_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (mask, part, fp) in order of the first two: links within each list, as a and b; the entries of
    a list that is too long come out again as a, with their mask."""

    def table(a, b, mask) -> pa.RecordBatch:
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(mask, pa.int64())], schema=_LINKS)

    def passed_on(rows: np.ndarray) -> pa.RecordBatch:
        return table(rows[2], pa.nulls(rows.shape[1], pa.int64()), rows[0])

    held = np.empty((3, 0), np.int64)  # the list that may go on in the next batch
    too_long = None  # the list whose entries are passed on
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        if not rows.shape[1]:
            continue
        if too_long is not None:
            same = (rows[0] == too_long[0]) & (rows[1] == too_long[1])
            if same.any():
                yield passed_on(rows[:, same])
            rows = rows[:, ~same]
            if not rows.shape[1]:
                continue
            too_long = None
        rows = np.concatenate([held, rows], axis=1)
        new = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
        starts = np.concatenate([[0], new])
        ends = np.concatenate([new, [rows.shape[1]]])
        held = rows[:, starts[-1] :]
        yield from _lists(rows, starts[:-1], ends[:-1], table, passed_on)
        if held.shape[1] > _LIST:
            yield passed_on(held)
            too_long, held = (held[0, 0], held[1, 0]), held[:, :0]
    if held.shape[1]:
        yield from _lists(held, np.array([0]), np.array([held.shape[1]]), table, passed_on)


def _lists(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, table, passed_on) -> Iterator[pa.RecordBatch]:
    entries, sizes = rows[2].view(np.uint64), ends - starts
    # Most lists have one entry or two; the latter are compared all at once.
    one = starts[sizes == 2]
    differ = entries[one] ^ entries[one + 1]
    tally = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    one = one[(tally >= _LEAST_BYTES) & (np.bitwise_count(differ) <= BITS)]
    a, b = [rows[2, one + 1]], [rows[2, one]]
    for start, end in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist()):
        if end - start > _LIST:
            yield passed_on(rows[:, start:end])
        elif links := connect(entries[start:end]):
            places = np.array(links) + start
            a.append(rows[2, places[:, 0]])
            b.append(rows[2, places[:, 1]])
    a, b = np.concatenate(a), np.concatenate(b)
    if len(a):
        yield table(a, b, pa.nulls(len(a), pa.int64()))


def links_between(entries: DataFrame) -> DataFrame:
    """`a, b`: links that connect what pairs of `entries(fp)`, all distinct, within three bits of each other do."""
    masks = F.array(*(F.lit(_signed(mask)) for mask in position_masks()))
    keys = entries.select(F.explode(masks).alias("mask"), "fp")
    links = None
    while True:
        lists = keys.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("part"), "fp")
        lists = lists.repartition("mask", "part").sortWithinPartitions("mask", "part")
        found = saved(lists.mapInArrow(_compare_lists, "a long, b long, mask long"), "byte_links")
        new = found.where("b is not null").select("a", "b")
        links = new if links is None else links.unionByName(new)
        long = found.where("b is null")
        used = [row["mask"] for row in long.select("mask").distinct().collect()]  # follows from 14 masks, not from the data
        if not used:
            return links
        finer = {mask: [_signed(x) for x in split_masks(mask % (1 << 64))] for mask in used}
        pairs = long.sparkSession.createDataFrame([(m, x) for m in finer for x in finer[m]], "mask long, finer long")
        keys = long.join(F.broadcast(pairs), "mask").select(F.col("finer").alias("mask"), F.col("a").alias("fp")).distinct()


def simhash_components(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`doc_id, fingerprint, component_id`, one row per input row.

    `component_id` is the least id that links reach from the row, its own included; null ids count only
    where there is no other. Null texts and those without words have the fingerprint zero, and link like
    any other; one or two words are one shingle. Repeated rows and ids stay rows of their own. An
    empty table gives no rows.
    """
    of = F.pandas_udf(_fingerprints, "long")(F.col(text).cast("string").cast("binary"))
    rows = saved(docs.select(F.col(doc_id).alias("doc_id"), of.alias("fp")), "fingerprints")
    entries = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "entries")
    labels = saved(components(links_between(entries.select("fp"))), "byte_labels")
    linked = entries.join(labels.withColumnRenamed("node", "fp"), "fp")
    whole = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    named = linked.select("fp", "label").join(whole, "label").select("fp", "component_id")
    named = entries.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(named, "fp").select("doc_id", digits, "component_id")
