"""Words and hashed word shingles, inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

# Bytes of words: digits, letters in lower case, everything beyond ASCII. All else separates words.
_FOLD = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, A-Z in lower case."""
    return text.encode().translate(_FOLD).split() if text else []


class WordHashes:
    """64-bit hashes of words. None is remembered: a look-up takes longer than the hash."""

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, found)), ">u8").astype(np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of unsigned 64-bit integers."""
    values = (values ^ (values >> np.uint64(31))) * _MIX
    values = (values ^ (values >> np.uint64(29))) * _MIX
    return values ^ (values >> np.uint64(32))


def mixed_pairs(seeds: np.ndarray, values: np.ndarray, out: np.ndarray, spare: np.ndarray) -> None:
    """`mixed(seed ^ value)` of all pairs into `out`, a row per seed; `spare` is work space of the same shape."""
    # The first step is linear in xor, so it needs no pass over the pairs.
    first = np.uint64(31)
    np.bitwise_xor((seeds ^ (seeds >> first))[:, None], values ^ (values >> first), out=out)
    for shift in (29, 32):
        np.multiply(out, _MIX, out=out)
        np.right_shift(out, np.uint64(shift), out=spare)
        np.bitwise_xor(out, spare, out=out)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` words; none if there are fewer words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    value = np.full(count, size, np.uint64)
    for i in range(size):
        value = (value * _MIX) ^ hashes[i : i + count]
        value ^= value >> np.uint64(32)
    return mixed(value)
