"""Whole texts of an Arrow batch as flat numpy arrays: bytes, words, lines and their 64-bit hashes.

Nothing here loops over words or bytes in Python. Documents keep their order; a null text counts as empty.
Words are runs of bytes outside 0x20 and 0x09-0x0D, which never cuts a UTF-8 character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once. A longer single text is handled alone.
CHUNK_BYTES = 1 << 19

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32

_U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
UNBASE = pow(BASE, -1, 1 << 64)
#: A random 64-bit value for each byte; fixed by its seed so that all tasks agree.
BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the process."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 4096)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: with them any substring gets its hash in constant time."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)), dtype=np.uint64, out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end), the same wherever the string stands; the length is part of it."""
    raw = (sums[end] - sums[start]) * powers(UNBASE, len(sums))[start]
    return mix(raw ^ ((end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93)))


class Texts:
    """Texts of consecutive documents in one byte array, each followed by one line end that is not part of it."""

    def __init__(self, first: int, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.first, self.data, self.start, self.size = first, data, start, size
        self.end = start + size
        self.n = len(start)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes()

    def words(self, data: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of every word."""
        gap = SPACE[self.data]
        edge = np.empty(len(gap) + 1, bool)
        edge[0] = True
        edge[1:] = gap
        word = ~gap
        start = np.flatnonzero(word & edge[:-1])
        last = np.empty(len(gap), bool)
        last[:-1] = gap[1:]
        if len(last):
            last[-1] = True
        end = np.flatnonzero(word & last) + 1
        return start, end, self.documents_of(start)

    def documents_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, position, side="right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end (without the line end) and document of every line; an empty text has one empty line."""
        end = np.flatnonzero(self.data == 10)
        start = np.empty(len(end), np.int64)
        if len(end):
            start[0] = 0
            start[1:] = end[:-1] + 1
        return start, end, self.documents_of(start)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a string column in pieces of about ``limit`` bytes, whole documents each."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    held = column.buffers()[2]
    raw = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, n)
        size = np.diff(offsets[first: last + 1])
        start = np.zeros(last - first, np.int64)
        start[1:] = np.cumsum(size[:-1] + 1)
        data = np.insert(raw[offsets[first]: offsets[last]], offsets[first + 1: last + 1] - offsets[first], 10)
        yield Texts(first, data, start, size)
        first = last


def word_hashes(texts: Texts, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word, in order."""
    start, end, doc = texts.words()
    sums = prefix_sums(LOWER[texts.data] if lower else texts.data)
    return span_hash(sums, start, end), doc


def counts_by(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights, minlength=n)


def shingles(words: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a document, and the position of each run's first word."""
    m = len(words) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:m] == doc[k - 1:])
    total = np.zeros(len(at), np.uint64)
    for j in range(k):
        total = mix(total + words[at + j] * _U(2 * j + 3))
    return total, at


def marked_runs(first: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of ``total`` positions lie in a run of ``length`` that begins at one of ``first``."""
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, np.minimum(first + length, total), -1)
    return np.cumsum(edge[:-1]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = twice[np.r_[True, twice[1:] != twice[:-1]]]
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return x.view(np.int64)
