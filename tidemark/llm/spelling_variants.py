"""Spelling variants: words one edit from a far more frequent one, by a bit-sliced position index.

The index of a set of words has, for each position and letter, a bitset of the words with that letter
there. All words of the set are looked up in it at once: for each, the set of words that agree so far, and
three sets of words with one error so far, in which letters are compared at the same position (one
replaced), one further (one inserted) or one before (one deleted). A letter moves all four sets on with a few
operations on whole machine words.

An index of the whole vocabulary would make the work grow with its square. Two words one edit apart agree
on their first or their last letters up to the edit: of m letters in the shorter one, on half of the other
m - 1 at one end. So words are grouped by such halves, and small groups indexed together. In a group that
is too large for one task, the letters between are halved again, until groups are small or there are no
letters left to halve; then a group is bounded by the alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import saved

RUN = re.compile("[A-Za-zÀ-ÿ]+")
EVERY = 31  # one run in so many loses a code point
LEAST_LETTERS, LEAST_COUNT, TIMES = 7, 2, 10
_FLUSH = 1 << 19  # distinct words counted by a task before it hands them on
_INDEXED = 512  # words of small groups that are indexed together
_GROUP = 4096  # words of a group that are indexed in one task; larger groups are divided


def fold(text: str) -> str:
    """A-Z in lower case, nothing else."""
    return text.encode().lower().decode()


def results(doc_id, text: str) -> Counter:
    """The runs of a text as they count: lower-cased, and shortened where the hash says so."""
    out: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(fold(text))).items():
        h = zlib.crc32(run.encode(), start)
        if h % EVERY == 0:
            place = h % len(run)
            run = run[:place] + run[place + 1 :]
        out[run] += n
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def table() -> pa.RecordBatch:
        words = [word for word in counts if len(word) >= LEAST_LETTERS]
        n = [counts[word] for word in words]
        return pa.record_batch([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                counts.update(results(doc_id, text))
                if len(counts) >= _FLUSH:
                    yield table()
                    counts = Counter()
    yield table()


def vocabulary(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`word, n` of all words with enough letters and occurrences."""
    rows = docs.select(F.col(doc_id).cast("string"), F.col(text).cast("string"))
    counts = rows.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def near_pairs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of all ordered pairs of the distinct words that are one edit apart."""
    count = len(words)
    lengths = np.array([len(word) for word in words])
    width = int(lengths.max())
    codes = np.zeros((count, width), np.uint8)  # zero behind the end
    for i, word in enumerate(words):
        codes[i, : len(word)] = np.frombuffer(word.encode("latin-1"), np.uint8)
    letters = np.unique(codes)
    number = np.zeros(256, np.uint8)
    number[letters] = np.arange(len(letters))
    size = -(-count // 64)

    def bitsets(groups: np.ndarray, of: int) -> np.ndarray:
        """For each group the bitset of the words in it; `groups` has the group of each word."""
        bits = np.zeros((of, size * 64), bool)
        bits[groups, np.arange(count)] = True
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)

    def index(position: int) -> np.ndarray:
        """For each letter the words that have it there; none outside all words."""
        if 0 <= position < width:
            return bitsets(number[codes[:, position]], len(letters))
        return np.zeros((len(letters), size), np.uint64)

    sizes = np.unique(lengths)
    of_length = dict(zip(sizes.tolist(), bitsets(np.searchsorted(sizes, lengths), len(sizes))))
    none = np.zeros(size, np.uint64)

    # Sets of indexed words, a row for each word that is looked up.
    equal = np.tile(bitsets(np.zeros(count, np.int64), 1), (count, 1))
    replaced, inserted, deleted, near = (np.zeros_like(equal) for _ in range(4))
    before, here, after = index(-1), index(0), index(1)
    for position in range(width + 1):
        if position in of_length:
            ends = np.flatnonzero(lengths == position)
            near[ends] = replaced[ends] & of_length[position]
            near[ends] |= (inserted[ends] | equal[ends]) & of_length.get(position + 1, none)
            near[ends] |= deleted[ends] & of_length.get(position - 1, none)
        if position < width:
            own = number[codes[:, position]]
            same = here[own]
            inserted = (inserted | equal) & after[own]
            deleted = deleted & before[own] | equal
            replaced = replaced & same | equal & ~same
            equal = equal & same
            before, here, after = here, after, index(position + 2)
    return np.nonzero(np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :count])


_FOUND = ["word", "near", "near_n", "shorter", "head", "tail"]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shorter, key, word, n, head, tail) in order of the first two: near pairs; the words of a group
    that is too large come out again, without a near word."""

    def pairs(rows: list) -> Iterator[pa.RecordBatch]:
        counts = {row[2]: row[3] for row in rows}
        words = list(counts)
        at, other = near_pairs(words) if len(words) > 1 else ([], [])
        if len(at):
            near = [words[i] for i in other.tolist()]
            columns = [pa.array([words[i] for i in at.tolist()]), pa.array(near), pa.array([counts[x] for x in near], pa.int64())]
            yield pa.record_batch(columns + [pa.nulls(len(near), pa.int32())] * 3, names=_FOUND)

    def passed_on(rows: list) -> Iterator[pa.RecordBatch]:
        if rows:
            shorter, _, words, n, head, tail = zip(*rows)
            ints = [pa.array(x, pa.int32()) for x in (shorter, head, tail)]
            columns = [pa.array(words), pa.nulls(len(words), pa.string()), pa.array(n, pa.int64()), *ints]
            yield pa.record_batch(columns, names=_FOUND)

    def rows_of() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))
        yield (None,) * 6  # ends the last group

    block: list = []  # rows of whole groups of one length
    group: list = []  # rows of the group that goes on
    key, large = (None, None), False
    for row in rows_of():
        if row[:2] != key:
            if large:
                yield from passed_on(group)
            elif len(group) > 1:  # a word alone has no pair in its group
                block += group
            if block and (len(block) >= _INDEXED or row[0] != key[0]):
                yield from pairs(block)
                block = []
            key, group, large = row[:2], [], False
        group.append(row)
        if len(group) > _GROUP and row[0] - row[4] - row[5] > 1:
            large = True
        if large and len(group) > _GROUP:
            yield from passed_on(group)
            group = []


def _near_words(words: DataFrame) -> DataFrame:
    """`word, near, near_n`: all ordered pairs of `words(word, n)` that are one edit apart."""
    shorter = F.expr("filter(array(length(word) - 1, length(word)), x -> x >= %d)" % LEAST_LETTERS)
    parts = words.select("word", "n", F.explode(shorter).alias("shorter"), F.lit(0).alias("head"), F.lit(0).alias("tail"))
    found = None
    while True:
        # Of the letters between, half of all but one agree at one end.
        half = "(shorter - head - tail) div 2"
        more = [F.expr(f"cast({end} + {half} as int)").alias(end) for end in ("head", "tail")]
        ends = F.array(F.struct(more[0], "tail"), F.struct("head", more[1]))
        parts = parts.select("word", "n", "shorter", F.explode(ends).alias("ends")).select("word", "n", "shorter", "ends.*")
        key = F.expr("xxhash64(shorter, head, tail, left(word, head), right(word, tail))").alias("key")
        rows = parts.select("shorter", key, "word", "n", "head", "tail").repartition("shorter", "key")
        rows = rows.sortWithinPartitions("shorter", "key")
        out = rows.mapInArrow(_search, "word string, near string, near_n long, shorter int, head int, tail int")
        out = saved(out, "near_words")
        new = out.where("near is not null").select("word", "near", "near_n")
        found = new if found is None else found.unionByName(new)
        parts = out.where("near is null").select("word", F.col("near_n").alias("n"), "shorter", "head", "tail")
        if parts.isEmpty():
            return found.distinct()
        parts = parts.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """`word, root`: from each word of `forms(word, form)` to where the forms end. Twice as far a turn;
    forms have at least ten times the occurrences of their words, so there are few turns."""
    roots = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = roots.join(further, "root", "left")
        if moved.where("further is not null").isEmpty():
            return roots
        roots = saved(moved.select("word", F.coalesce("further", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`word, form, root, n, n_near, form_n` for every word of at least 7 letters and 2 occurrences.

    `form` is the most frequent word one edit away, the least of equal ones, if it has ten times the
    occurrences; `root` is where forms lead in the end, the word itself without a form. Null and
    empty texts have no words; a null id counts as an empty one. Repeated rows count as often as they occur. An
    empty table gives no rows.
    """
    words = saved(vocabulary(docs, text=text, doc_id=doc_id), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = _near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    named = words.join(near, "word", "left")
    enough = -F.col("best.less") >= TIMES * F.col("n")
    named = saved(
        named.select(
            "word",
            F.when(enough, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    found = named.join(_roots(named.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
