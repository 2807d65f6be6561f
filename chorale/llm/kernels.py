"""Vectorised text kernels shared by the operators of this subpackage.

All work on the UTF-8 buffer of an Arrow string array, so a batch of texts is
processed by a handful of numpy passes and never word by word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are cut into chunks of about this many bytes, so that a kernel's
#: temporaries stay near 100 MB whatever the size of the Arrow batch. A single
#: longer text is a chunk of its own and is never cut.
CHUNK_BYTES = 2 << 20

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _stream(seed: int, n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


class WordHash:
    """64-bit hashes of words and of sequences of ``k`` words.

    A word is a polynomial over a random byte table modulo 2^64; two objects of
    different seeds give independent hashes, and both together 128 bits.
    """

    def __init__(self, seed: int, lower_ascii: bool = False):
        self.table = _stream(seed, 256)
        if lower_ascii:
            self.table[ord("A") : ord("Z") + 1] = self.table[ord("a") : ord("z") + 1]
        base, self.step = (int(x) | 1 for x in _stream(seed ^ 0x5DEECE66D, 2))
        self.base = U64(base)
        self.powers = np.ones(1, U64)

    def _powers(self, n: int) -> np.ndarray:
        while len(self.powers) < n:
            self.powers = np.concatenate([self.powers, self.powers * (self.base ** U64(len(self.powers)))])
        return self.powers

    def words(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, U64)
        lens = ends - starts
        at = np.cumsum(lens) - lens
        inside = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(at, lens)
        body = buf[inside + np.repeat(starts, lens)]
        value = self.table[body] * self._powers(int(lens.max()))[inside]
        return mix64(np.add.reduceat(value, at) + lens.astype(U64))

    def windows(self, words: np.ndarray, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each word on; the caller picks the starts that stay inside a text."""
        n = len(words) - k + 1
        if n <= 0:
            return np.zeros(0, U64)
        out = np.zeros(n, U64)
        factor = 1
        for j in range(k):
            out += words[j : j + n] * U64(factor)
            factor = factor * self.step % (1 << 64)
        return mix64(out)


@dataclass
class Words:
    """The words of a chunk of texts: byte spans in ``buf``, and for each text its range of words."""

    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def window_starts(self, k: int) -> np.ndarray:
        """Mask over the words: a window of ``k`` words of one text starts here."""
        n = len(self.starts)
        last = np.repeat(self.first[1:], self.counts)
        return np.arange(n) + k <= last

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def find_words(buf: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``; none spans two texts."""
    space = np.ones(len(buf) + 1, bool)
    space[:-1] = _IS_SPACE[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    inside = ~space
    before = np.zeros(len(buf) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut))
    ends = np.flatnonzero(before & (~inside | cut))
    return Words(buf, offsets, starts, ends, np.searchsorted(starts, offsets))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of at most ``limit`` bytes together: first row, end row, bytes, offsets."""
    buf, offsets = text_buffer(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes of text each (one row at least)."""
    at = batch.schema.get_field_index(column)
    for i, j, _, _ in chunks(batch.column(at), limit):
        yield batch.slice(i, j - i)


#: What empties the caches that an operator keeps in a worker process.
CACHES: list[Callable[[], None]] = []


def trim() -> None:
    """Gives freed blocks back that Arrow and the C library hold on to."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give:
        give(0)


def release() -> None:
    """Empties the caches that another operator's tasks have left in this worker process, and trims."""
    for clear in CACHES:
        clear()
    trim()
