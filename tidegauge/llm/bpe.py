"""Byte-level BPE with given ranks, as a tree reduction.

A piece (one match of the splitting pattern) is encoded by halves: both halves are encoded on their own and
joined. A join encodes a window around the boundary anew, first one token on each side, and grows it until
the tokens next to it are stable: a sequence is the encoding of its bytes if and only if each two
neighbours are what encoding their joint bytes gives, and inside the halves and the window that holds already.
Joining is associative, so any tree gives the same tokens. Decoding joins the tokens' bytes up a tree.

Ids travel as packed little-endian 32-bit numbers in a binary column.
"""

from __future__ import annotations

import base64
import functools
import heapq
import struct
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.common import quoted, small_batches

_LEAF = 6  # bytes that are merged without halving
_SHORT = 48  # bytes that are merged without a heap
_KNOWN = 100_000  # entries of each generation of what a worker remembers of parts and pairs
_PIECES = 300_000  # the same of whole pieces, of at most
_REMEMBERED = 32  # characters
_LONG = 1_000_000  # characters from which pieces are not listed at once


class _Recent(dict):
    """A bounded memory: when it is full, it becomes the older generation, and what is used again comes back.
    Keys beyond `longest` are made anew each time."""

    def __init__(self, make, size=_KNOWN, longest=None):
        super().__init__()
        self.make, self.size, self.longest, self.older = make, size, longest, {}

    def __missing__(self, key):
        if self.longest is not None and len(key) > self.longest:
            return self.make(key)
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Encodes and decodes bytes by a rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern)
        self.known = _Recent(self.piece, _PIECES, _REMEMBERED)
        self.parts = _Recent(self.merge)
        self.pairs = _Recent(self._stable)

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Plain merging: the pair of lowest rank first, of equal ones the leftmost."""
        if len(data) > _SHORT:
            return self._merge_long(data)
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def _merge_long(self, data: bytes) -> tuple[int, ...]:
        """The same with a heap of candidate pairs (rank, start, middle, end), for long windows."""
        n, ranks = len(data), self.ranks
        end = list(range(1, n + 1))  # of the part that starts at a place; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(start: int) -> None:
            middle = end[start]
            if middle < n:
                rank = ranks.get(data[start : end[middle]])
                if rank is not None:
                    heapq.heappush(heap, (rank, start, middle, end[middle]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, start, middle, stop = heapq.heappop(heap)
            if end[start] != middle or end[middle] != stop:
                continue
            end[start], end[middle] = stop, 0
            if stop < n:
                before[stop] = start
            offer(start)
            if start > 0:
                offer(before[start])
        out, at = [], 0
        while at < n:
            out.append(ranks[data[at : end[at]]])
            at = end[at]
        return tuple(out)

    def _stable(self, pair: tuple[int, int]) -> bool:
        """Whether two tokens stay as they are when they stand side by side."""
        return self.merge(self.tokens[pair[0]] + self.tokens[pair[1]]) == pair

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The tokens of two encoded neighbours together."""
        if not left or not right:
            return left or right
        if self.pairs[left[-1], right[0]]:
            return left + right
        take_left, take_right = 1, 1
        while True:
            head, tail = left[: len(left) - take_left], right[take_right:]
            window = b"".join(map(self.tokens.__getitem__, left[len(left) - take_left :] + right[:take_right]))
            middle = self.merge(window)
            loose_left = bool(head) and not self.pairs[head[-1], middle[0]]
            loose_right = bool(tail) and not self.pairs[middle[-1], tail[0]]
            if not loose_left and not loose_right:
                return head + middle + tail
            take_left = min(len(left), 2 * take_left) if loose_left else take_left
            take_right = min(len(right), 2 * take_right) if loose_right else take_right

    def tree(self, data: bytes) -> tuple[int, ...]:
        """Halves recursively, then joins."""
        n = len(data)
        if n <= _LEAF:
            return self.parts[data]
        return self.join(self.tree(data[: n // 2]), self.tree(data[n // 2 :]))

    def piece(self, piece: str) -> bytes:
        """Packed ids of one match of the pattern."""
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = (whole,) if whole is not None else self.tree(data)
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if len(text) < _LONG:
            pieces = self.split.findall(text)
        else:
            pieces = (m.group() for m in self.split.finditer(text))
        return b"".join(map(self.known.__getitem__, pieces))

    def decode(self, packed: bytes) -> bytes:
        ids = struct.unpack(f"<{len(packed) // 4}I", packed)

        def joined(low: int, high: int) -> bytes:
            if high - low <= 4096:
                return b"".join(map(self.tokens.__getitem__, ids[low:high]))
            middle = (low + high) // 2
            return joined(low, middle) + joined(middle, high)

        return joined(0, len(ids))


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Packed ids of a text column; null counts as empty. `path` is a rank file that every executor can
    read at that place, as part of the installation."""
    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path, pattern)
        for batch in batches:
            yield pd.Series([own.encode(t) if t else b"" for t in batch], dtype=object)

    return encode(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of packed ids; null gives null."""
    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path, pattern)
        for batch in batches:
            yield pd.Series([None if p is None else own.decode(p) for p in batch], dtype=object)

    return decode(ids)


def tokenize(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The documents with `ids` (packed) and `n_tokens`. Nothing is shuffled; no row is added or removed.
    Null and empty texts have no tokens; texts of any length are encoded whole. Columns of these names are replaced."""
    small_batches(docs.sparkSession)
    return docs.withColumn("ids", encoded(quoted(text_col).cast("string"), path, pattern)).withColumn(
        "n_tokens", (F.length("ids") / 4).cast("long"))
