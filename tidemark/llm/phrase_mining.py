"""Phrase collocations per language, mined by the SON partition method.

The rows are divided into a few shards. Each shard is mined completely at the support that its share of a
language's words makes of the whole support: a phrase with 30 occurrences in all must reach that in some
shard. What is frequent in any shard is a candidate, and all candidates are then counted exactly over all rows. A shard is a set of tasks, not one task: with more
shards than the support, a phrase of one occurrence would be frequent somewhere, and nothing would be left out.

Shards are mined by length. Words are counted exactly first; only words with the whole support can be in
a phrase. Bigrams of such words follow, then phrases of three and of four words whose parts one word shorter
are candidates. Tasks count hashes of phrases in blocks and hand on one row per phrase and block, so a frequent
phrase is no hot key. Candidates are handed to tasks as a bitmap of their hashes; it lets some phrases
through that are no candidates, but loses none, and the last count is of the phrases themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bitmap import Bitmap
from tidemark.llm.shingles import mixed
from tidemark.llm.tables import saved
from tidemark.storage import materialised

SUPPORT, LONGEST, BEST = 30, 4, 2000
UNDEFINED = "und"
INSIDE = 80  # a candidate goes if a longer one has this many hundredths of its occurrences
SCALE = 2_000_000
_SHARDS = 3  # local support is a third of nearly the whole where shards are even
_FEW = 100_000  # rows that are broadcast
_BLOCK = 1 << 18  # words counted at a time
_CHUNK = 1 << 20  # bytes of text split into words at a time
_OUT = 1 << 16  # rows handed on at a time

# Upper case to lower, ends of pieces to a byte that UTF-8 never has, tabs to spaces.
_END = b"\xff"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _END * 10 + b" ")

_UNCHECKED = pc.CastOptions(pa.large_string(), allow_invalid_utf8=True)


def split_words(texts: list[bytes]) -> pa.Array:
    """The words of texts in UTF-8, with `_END` where a piece ends."""
    folded = _END.join([*texts, b""]).translate(_FOLD).replace(_END, b" \xff ").strip()
    whole = pc.cast(pa.array([folded], pa.large_binary()), options=_UNCHECKED)
    return pc.ascii_split_whitespace(whole).flatten().cast(pa.large_binary())


def word_hashes(words: Iterable[bytes], lang: str, allowed: Bitmap | None = None) -> np.ndarray:
    """64-bit hashes of a language's words; 0 for ends of pieces and for words that a bitmap has not."""
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    out = np.array([0 if word == _END else xxhash.xxh3_64_intdigest(word, seed) or 1 for word in words], np.uint64)
    if allowed is not None:
        out[~allowed.has(out)] = 0
    return out


def grams(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For lengths from 2 to `LONGEST`: the hash at each place, and whether a phrase of that length is there."""
    value, whole = hashes, hashes != 0
    for size in range(2, LONGEST + 1):
        last = hashes[size - 1 :]
        value = mixed(mixed(value[: len(last)] + np.uint64(size)) ^ last)
        whole = whole[: len(last)] & (last != 0)
        yield size, value, whole


class _Block:
    """Words of texts of one language."""

    def __init__(self) -> None:
        self.parts, self.texts, self.bytes = [pa.array([_END], pa.large_binary())], [], 0

    def add(self, text: bytes) -> int:
        """The number of words that this has split off."""
        self.texts.append(text)
        self.bytes += len(text)
        return self.split() if self.bytes >= _CHUNK else 0

    def split(self) -> int:
        if not self.texts:
            return 0
        self.parts.append(split_words(self.texts))
        self.texts, self.bytes = [], 0
        return len(self.parts[-1])

    def done(self) -> tuple[np.ndarray, np.ndarray]:
        """All words as numbers in order of appearance, so that ends of pieces are 0, and the words themselves."""
        self.split()
        words = pa.concat_arrays(self.parts).dictionary_encode()
        self.parts = []
        pa.default_memory_pool().release_unused()
        return words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, np.ndarray, np.ndarray]]:
    """`shard, lang, numbers of words, words` of blocks of texts; a block ends only between texts."""
    held: dict[str, _Block] = {}
    count, shard = 0, 0
    for batch in batches:
        texts, langs, parts = (batch.column(i) for i in range(3))
        for i in range(batch.num_rows):
            if text := texts[i].as_py():
                shard, lang = parts[i].as_py() % _SHARDS, langs[i].as_py()
                if lang not in held:
                    held[lang] = _Block()
                count += held[lang].add(text)
                if count >= _BLOCK:
                    done, held, count = held, {}, 0
                    while done:
                        lang, block = done.popitem()
                        yield shard, lang, *block.done()
    while held:
        lang, block = held.popitem()
        yield shard, lang, *block.done()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, lang, block, words in _blocks(batches):
        n = np.bincount(block, minlength=len(words))
        columns = [pa.array([lang] * (len(words) - 1), pa.string()), pa.array(words[1:], pa.binary()), pa.array(n[1:])]
        yield from pa.table(columns, names=["lang", "word", "n"]).to_batches(max_chunksize=1 << 16)


def _hashes_of(rows: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for langs, words in rows:
        yield pd.Series(np.array([word_hashes([w], lang)[0] for lang, w in zip(langs, words)], np.uint64).view(np.int64))


def _mine(length: int, words: Bitmap, shorter: Bitmap | None) -> Callable:
    """Counts phrases of one length in each block: those of frequent words of which both parts one word shorter are
    candidates, if these are known. A row without a hash has the number of words of its block."""

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, lang, block, known in _blocks(batches):
            hashes, allowed = word_hashes(known, lang, words)[block], None
            for size, value, whole in grams(hashes):
                if size == length - 1:
                    allowed = whole.copy()
                    allowed[whole] = shorter.has(value[whole])
                if size == length:
                    found = value[whole if allowed is None else whole & allowed[: len(whole)] & allowed[1 : len(whole) + 1]]
                    break
            del hashes, value, whole
            each, n = np.unique(found, return_counts=True)
            yield _shard_rows(shard, lang, pa.nulls(1, pa.int64()), pa.array([np.count_nonzero(block)]))
            for start in range(0, len(each), _OUT):
                part = slice(start, start + _OUT)
                yield _shard_rows(shard, lang, pa.array(each[part].view(np.int64)), pa.array(n[part]))

    return mine


def _shard_rows(shard: int, lang: str, hashes: pa.Array, n: pa.Array) -> pa.RecordBatch:
    size = len(hashes)
    columns = [pa.array(np.full(size, shard, np.int32)), pa.array([lang] * size, pa.string()), hashes, n]
    return pa.record_batch(columns, names=["shard", "lang", "hash", "n"])


def _candidates(texts: DataFrame, mine: Callable) -> Bitmap:
    """The phrases that have their local support in some shard.

    Supports that add up to less than `SUPPORT` when each is lowered by one leave no phrase out. A shard's is its share of
    `SUPPORT - (_SHARDS - 1)`, rounded up, but at least two: of shards so raised there are fewer than `_SHARDS`.
    """
    rows = texts.mapInArrow(mine, "shard int, lang string, hash long, n long")
    rows = rows.groupBy("shard", "lang", "hash").agg(F.sum("n").alias("n")).where("hash is null or n > 1")
    with materialised(rows, "mined") as counts:
        size = counts.where("hash is null").select("shard", "lang", F.col("n").alias("words")).where("words > 0")
        whole = size.groupBy("lang").agg(F.sum("words").alias("all_words"))
        # Rounded up in whole numbers, beyond 64 bits if need be.
        share = F.expr(f"cast((cast(words as decimal(20, 0)) * {SUPPORT - _SHARDS + 1} + all_words - 1) div all_words as long)")
        support = size.join(whole, "lang").select("shard", "lang", F.greatest(share, F.lit(2)).alias("support"))
        support = saved(support, "supports")
        if support.count() <= _FEW:  # a row per shard and language
            support = F.broadcast(support)
        found = counts.where("hash is not null").join(support, ["shard", "lang"]).where("n >= support")
        return Bitmap.of(saved(found.select("hash").distinct(), "candidates"))


def _count_candidates(words: Bitmap, candidates: dict[int, Bitmap]) -> Callable:
    """Counts the phrases of each block that pass the bitmaps of their lengths, by the words themselves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, lang, block, known in _blocks(batches):
            hashes = word_hashes(known, lang, words)[block]
            numbers, stands = block, None  # of phrases of the length before, and where they stand
            for size, value, whole in grams(hashes):
                if stands is not None:  # a phrase needs the one without its last word
                    whole = whole & (stands[: len(whole)] >= 0)
                at = np.flatnonzero(whole)
                at = at[candidates[size].has(value[at])]
                if not len(at):
                    break
                before = numbers[at] if stands is None else numbers[stands[at]]
                # Both numbers are below 2 ** 31, so that equal codes mean equal words.
                code = before.astype(np.int64) * len(known) + block[at + size - 1]
                _, first, numbers, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
                stands = np.full(len(block), -1, np.int32)
                stands[at] = np.arange(len(at))
                runs = block[at[first][:, None] + np.arange(size)].tolist()
                phrases = [b" ".join([known[i] for i in run]) for run in runs]
                columns = [pa.array([lang] * len(n), pa.string()), pa.array(phrases, pa.binary())]
                columns += [pa.array(np.full(len(n), size, np.int32)), pa.array(n)]
                yield from pa.table(columns, names=["lang", "phrase", "size", "n"]).to_batches(max_chunksize=_OUT)

    return count


def frequent_phrases(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """`lang, phrase, size, a` of all words and phrases with the support, and `lang, n` of all languages."""
    language = F.coalesce(F.col(lang).cast("string"), F.lit(UNDEFINED)).alias("lang")
    texts = docs.select(F.col(text).cast("string").cast("binary").alias("text"), language, F.spark_partition_id().alias("part"))
    counted = texts.mapInArrow(_count_words, "lang string, word binary, n long")
    words = saved(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= SUPPORT)
    word_bits = Bitmap.of(saved(frequent.select(F.pandas_udf(_hashes_of, "long")("lang", "word").alias("hash")), "frequent_words"))
    candidates: dict[int, Bitmap] = {}
    for length in range(2, LONGEST + 1):
        candidates[length] = _candidates(texts, _mine(length, word_bits, candidates.get(length - 1)))
    exact = texts.mapInArrow(_count_candidates(word_bits, candidates), "lang string, phrase binary, size int, n long")
    exact = exact.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a")).where(F.col("a") >= SUPPORT)
    single = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), F.col("n").alias("a"))
    every = exact.unionByName(single).withColumn("phrase", F.col("phrase").cast("string"))
    return saved(every, "frequent_phrases"), total


def _run(first: Column, length: Column) -> Column:
    return F.array_join(F.slice("words", first, length), " ")


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """`lang, rank, phrase, a, l, r, n, score`: the best 2,000 phrases of two to four words per language.

    A phrase occurs at least 30 times. Its score is that of the worst of its cuts, two million times
    its occurrences by those of both parts; phrases that a longer one holds in four of five occurrences are left
    out. Equal scores go by occurrences, then by the phrase's bytes. Null texts are empty; a null language
    is `und`. Repeated rows count as often as they occur. An empty table gives no rows.
    """
    every, total = frequent_phrases(docs, text=text, lang=lang)
    known = every.select("lang", "phrase", "a")
    phrases = every.where("size > 1").withColumn("words", F.split("phrase", " "))

    cuts = phrases.select("lang", "phrase", "size", "a", "words", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", _run(F.lit(1), F.col("k")).alias("head"), _run(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    rests = known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"])
    score = F.expr(f"cast((cast(a as decimal(20, 0)) * {SCALE}) div (l + r) as long)")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("worst")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(worst)

    starts = phrases.where("size > 2").select("a", "lang", "size", "words", F.explode(F.expr("sequence(2, size - 1)")).alias("length"))
    starts = starts.select("a", "lang", "words", "length", F.explode(F.expr("sequence(1, size - length + 1)")).alias("start"))
    held = starts.select("lang", _run(F.col("start"), F.col("length")).alias("phrase"), "a")
    held = held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(held, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {INSIDE} * a")

    left = left.select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
