"""Sets of 64-bit hashes as bitmaps of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEAST_BITS, _MOST_BITS = 16, 26  # a bitmap has 2 ** 26 bits, 8 MB, at most
_BITS_EACH = 32  # bits per hash, as long as the most allows


class Bitmap:
    """Hashes, each as two of 2 ** bits bits, its first and its last: true for every hash of the set, and for
    some others. Sized by the set up to a most; beyond, more of the others pass."""

    def __init__(self, bits: int, words: np.ndarray) -> None:
        self.shift, self.low, self.words = np.uint64(64 - bits), np.uint64((1 << bits) - 1), words

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = self._bit(hashes >> self.shift)
        out[out] = self._bit(hashes[out] & self.low)
        return out

    @staticmethod
    def of(hashes: DataFrame) -> Bitmap:
        """Of `hashes(hash)`; at most 2 ** (_MOST_BITS - 6) rows of two numbers reach the driver, by Arrow."""
        bits = min(max(int(_BITS_EACH * hashes.count()).bit_length(), _LEAST_BITS), _MOST_BITS)
        places = F.array(F.shiftrightunsigned("hash", 64 - bits), F.col("hash").bitwiseAND((1 << bits) - 1))
        rows = hashes.select(F.explode(places).alias("at")).selectExpr("shiftright(at, 6) word", "shiftleft(1L, cast(at & 63 as int)) bit")
        rows = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        words = np.zeros(1 << (bits - 6), np.int64)
        words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
        return Bitmap(bits, words.view(np.uint64))


def filter_of(values: DataFrame) -> Callable[[str], Column]:
    """A condition on a column of another table: false only for what the only column of `values` does not hold."""
    bitmap = Bitmap.of(values.select(F.xxhash64(values.columns[0]).alias("hash")))

    def test(hashes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in hashes:
            yield pd.Series(bitmap.has(batch.to_numpy(np.int64).view(np.uint64)))

    udf = F.pandas_udf(test, "boolean")
    return lambda name: udf(F.xxhash64(name))
