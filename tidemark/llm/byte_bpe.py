"""Byte-level BPE by a transducer: bytes in, tokens out, without a merge loop.

A token sequence is the encoding of its bytes exactly when every token encodes itself and every
neighbouring pair encodes to that pair. This makes encoding a finite-state transduction: read bytes
down the vocabulary's trie, close a token where the pair with the one before it holds. Several
readings stay open at once, so the transducer is determinised: a state is the set of open readings,
with the tokens they already agree on emitted and the rest kept as delayed output. States and their
transitions are built when a text first needs them. No reading is open for longer than the longest
token, which bounds the lookahead.

Decoding keeps a UTF-8 state between chunks, so that a character cut by a chunk's end is completed by
the next chunk.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.worker import kept

ENCODED = "n_tokens long, ids binary, decoded_sha256 string"
_WINDOW = 1 << 20  # characters split into matches at a time
_STATES = 400_000  # determinised states kept; beyond, the table is begun anew
_MATCHES = 400_000  # matches whose output is remembered; beyond, begun anew
_PAIRS = 100_000  # verdicts on neighbouring tokens kept; beyond, begun anew (one takes less time than a state)
_SMALL = 4  # tokens below a trie node up to which dead readings are sought
_BREAK = regex.compile(r"(?<=\S)\s")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encodes one match at a time; `states` grows lazily and is bounded."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._parts: dict[bytes, tuple[bytes, bytes]] = {}
        # Two numbers that make a key are one integer: half the memory of a pair of them, or of a dictionary each.
        self._edges: dict[int, list[tuple[bytes, int, int]]] = {}
        self._pairs: dict[int, bool] = {}
        self._live: dict[int, bool] = {}
        self._trie()
        self._reset()

    def _trie(self) -> None:
        """Node 0 is the root; `child` has the node below node << 8 | byte, `inner` whether there are any.
        Tokens that merging cannot reach are left out; see `encode`."""
        self.child: dict[int, int] = {}
        self.inner = bytearray(1)
        self.ends: list[int] = [-1]
        below: list[list[int]] = [[]]
        for token, rank in self.ranks.items():
            if len(token) > 1:
                halves = self._halves(token)
                if halves is None:
                    continue
                self._parts[token] = halves
            node = 0
            for byte in token:
                found = self.child.get(node << 8 | byte)
                if found is None:
                    found = self.child[node << 8 | byte] = len(self.ends)
                    self.inner[node] = 1
                    self.inner.append(0)
                    self.ends.append(-1)
                    below.append([])
                node = found
                if len(below[node]) <= _SMALL:
                    below[node].append(rank)
            self.ends[node] = rank
        self.below = below

    def _reset(self) -> None:
        # A state's readings: (delayed output, last token, trie node). Moves: number << 8 | byte -> (output, number << 8).
        start = (((), -1, 0),)
        self._numbers = {start: 0}
        self._readings = [start]
        self.moves: dict[int, tuple[tuple[int, ...], int]] = {}
        self.finals: list[tuple[int, ...]] = [()]

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """What the last merge of a token joins, None if merging does not end in the token."""
        ranks = self.ranks
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, i = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                return None
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return (parts[0], parts[1])

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """The tokens that stand at one edge of `token` while it is merged, the last one first: bytes, and
        the ranks of the merges that make it and that end it."""
        key = token << 1 | side
        found = self._edges.get(key)
        if found is None:
            piece, until, found = self.tokens[token], 1 << 60, []
            while piece in self._parts:
                found.append((piece, self.ranks[piece], until))
                until, piece = self.ranks[piece], self._parts[piece][side]
            found.append((piece, -1, until))
            self._edges[key] = found
        return found

    def _follows(self, left: int, right: int) -> bool:
        """Whether the two tokens' bytes encode to the two tokens: no merge joins them across the border.

        Walks back from the end of merging. The tokens at the border stay side by side until the next
        merge of either; a join of lower rank comes first. At equal ranks the leftmost merge comes first.
        """
        if left < 0:
            return True
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is not None:
            return known
        lefts, rights, i, j = self._edge(left, 1), self._edge(right, 0), 0, 0
        known = True
        while True:
            (a, made_a, until_a), (b, made_b, until_b) = lefts[i], rights[j]
            rank = self.ranks.get(a + b)
            if rank is not None and rank < until_a and rank <= until_b:
                known = False
                break
            if made_a < 0 and made_b < 0:
                break
            if made_a > made_b:
                i += 1
            else:
                j += 1
        if len(self._pairs) > _PAIRS:
            self._pairs.clear()
        self._pairs[key] = known
        return known

    def _open(self, left: int, node: int) -> bool:
        """Whether some token below the node may follow `left`; large subtrees count as open."""
        below = self.below[node]
        if left < 0 or node == 0 or len(below) > _SMALL:
            return True
        key = left << 32 | node
        known = self._live.get(key)
        if known is None:
            if len(self._live) > _PAIRS:
                self._live.clear()
            known = self._live[key] = any(self._follows(left, token) for token in below)
        return known

    def _step(self, state: int, byte: int) -> tuple[tuple[int, ...], int]:
        readings = []
        closed = None
        for output, last, node in self._readings[state >> 8]:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.ends[node]
            if token >= 0 and self._follows(last, token):
                closed = ((*output, token), token, 0)
            if self.inner[node] and self._open(last, node):
                readings.append((output, last, node))
        readings.append(closed)  # the encoding of all bytes so far: there is exactly one
        agreed, first = 0, closed[0]
        if len(readings) > 1:
            # What the least and the greatest begin with, all do.
            outputs = [reading[0] for reading in readings]
            first, most = min(outputs), max(outputs)
            while agreed < len(first) and agreed < len(most) and first[agreed] == most[agreed]:
                agreed += 1
        else:
            agreed = len(first)
        key = tuple([(output[agreed:], last, node) for output, last, node in readings]) if agreed else tuple(readings)
        number = self._numbers.get(key)
        if number is None:
            number = self._numbers[key] = len(self._readings) << 8
            self._readings.append(key)
            self.finals.append(key[-1][0])
        move = self.moves[state | byte] = (first[:agreed], number)
        return move

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one match. A match that is itself a token is that token, as in the rank files' library."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self._readings) > _STATES:
            self._reset()
        ids: list[int] = []
        state, moves = 0, self.moves
        for byte in piece:
            move = moves.get(state | byte)
            output, state = move if move is not None else self._step(state, byte)
            if output:
                ids.extend(output)
        ids.extend(self.finals[state >> 8])
        return ids


class _Matches(dict):
    """Match -> its ids as little-endian unsigned 32-bit integers, by the transducer."""

    def __init__(self, transducer: Transducer) -> None:
        super().__init__()
        self.transducer = transducer

    def __missing__(self, match: str) -> bytes:
        packed = np.array(self.transducer.encode(match.encode()), "<u4").tobytes()
        if len(match) <= 64:
            if len(self) >= _MATCHES:
                self.clear()
            self[match] = packed
        return packed


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.transducer = Transducer(ranks)
        self._matches = _Matches(self.transducer)
        self._pattern = regex.compile(pattern)

    def encode_chunks(self, text: str) -> Iterator[bytes]:
        """Packed ids, window by window. A window ends before white space that follows something else:
        no match of the pattern goes across such a place."""
        start, end = 0, len(text)
        while start < end:
            stop = end
            if end - start > _WINDOW and (cut := _BREAK.search(text, start + _WINDOW)):
                stop = cut.start()
            yield b"".join(map(self._matches.__getitem__, self._pattern.findall(text[start:stop])))
            start = stop

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(self.encode_chunks(text)), "<u4").tolist()

    def decode_chunks(self, packed: Iterable[bytes]) -> Iterator[bytes]:
        tokens = self.transducer.tokens
        for chunk in packed:
            yield b"".join([tokens[rank] for rank in np.frombuffer(chunk, "<u4").tolist()])


class Utf8Stream:
    """Incremental UTF-8 reader: gives the characters that are complete and keeps the open rest.

    The state is what the next byte may be: the lowest and highest byte allowed and how many follow it.
    An ill-formed byte raises ValueError, as does `close` inside a character.
    """

    def __init__(self) -> None:
        self._rest = b""
        self._low, self._high, self._owed = 0x80, 0xBF, 0

    def feed(self, chunk: bytes) -> str:
        """Steps over the rest of an open character and over one that the chunk leaves open; what lies between
        are whole characters, which the codec checks."""
        start = 0
        while self._owed and start < len(chunk):
            self._move(chunk[start])
            start += 1
        done = self._rest + chunk[:start]
        if self._owed:
            self._rest = done
            return ""
        end = len(chunk)
        for at in range(end - 1, max(start, end - 3) - 1, -1):
            if chunk[at] < 0x80:
                break
            if chunk[at] >= 0xC0:
                self._move(chunk[at])
                for byte in chunk[at + 1 :]:
                    if self._owed:
                        self._move(byte)
                if self._owed:
                    end = at
                break
        self._rest = chunk[end:]
        return done.decode() + chunk[start:end].decode()

    def _move(self, byte: int) -> None:
        if self._owed:
            if not self._low <= byte <= self._high:
                raise ValueError("not a continuation byte")
            self._low, self._high, self._owed = 0x80, 0xBF, self._owed - 1
            return
        self._low, self._high = 0x80, 0xBF
        if 0xC2 <= byte <= 0xDF:
            self._owed = 1
        elif 0xE0 <= byte <= 0xEF:
            self._owed = 2
            if byte == 0xE0:
                self._low = 0xA0  # no overlong form
            elif byte == 0xED:
                self._high = 0x9F  # no surrogates
        elif 0xF0 <= byte <= 0xF4:
            self._owed = 3
            if byte == 0xF0:
                self._low = 0x90
            elif byte == 0xF4:
                self._high = 0x8F
        else:
            raise ValueError("not a leading byte")

    def close(self) -> None:
        if self._owed:
            raise ValueError("a character is cut off")


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process, of the last vocabulary, while its tasks follow each other."""
    tables = kept("byte_bpe")
    if (path, pattern) not in tables:
        tables.clear()
        tables[path, pattern] = Codec(load_ranks(path), pattern)
    return tables[path, pattern]


def decode_text(coder: Codec, packed: Iterable[bytes]) -> Iterator[str]:
    """Characters of the ids, chunk by chunk."""
    stream = Utf8Stream()
    for chunk in coder.decode_chunks(packed):
        yield stream.feed(chunk)
    stream.close()


def encode_documents(
    docs: DataFrame, path: str, pattern: str, *, doc_id: str | Column = "doc_id", text: str | Column = "text"
) -> DataFrame:
    """Ids of every whole text, with the digest of the text they decode to.

    `path` names the rank file on every executor, `pattern` splits the text before merging. One row
    per input row: `doc_id, n_tokens, ids` (little-endian unsigned 32-bit), `decoded_sha256`. A null or
    empty text has no tokens; an id of any type stays as it is; repeated rows give repeated rows; other columns
    are ignored. Nothing is shuffled.
    """
    doc_id, text = (F.col(c) if isinstance(c, str) else c for c in (doc_id, text))
    rows = docs.select(doc_id.alias("doc_id"), text.cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in batches:
            out = []
            for one in batch.column(1):
                chunks = list(coder.encode_chunks(one.as_py() or ""))
                decoded = hashlib.sha256()
                for characters in decode_text(coder, chunks):
                    decoded.update(characters.encode())
                ids = b"".join(chunks)
                out.append((len(ids) // 4, ids, decoded.hexdigest()))
            columns = zip(*out) if out else ((), (), ())
            found = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.string()))]
            yield pa.record_batch([batch.column(0), *found], names=["doc_id", "n_tokens", "ids", "decoded_sha256"])

    return rows.mapInArrow(encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {ENCODED}")
