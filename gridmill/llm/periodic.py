"""Periodic runs of words, found on a harmonic grid by longest common extensions over a difference cover.

A run is a stretch of words with smallest period q and at least ``max(least, times * q)`` words that cannot be extended. Words q
apart are equal in at least ``(times - 1) * q`` places in a row there, so one of these places is a multiple of ``(times - 1) * q``:
for each period only these grid places are looked at, n / q of them, n log n in all.

1. Places of the grid at which the words q apart differ are left out at once, then those without enough equal words q, 2q, ... away.
2. How far a match reaches to either side is a longest common extension. Both places are moved on, word by word, until both are in
   the difference cover (residues of which any two meet within ``MODULUS`` words).
3. Only suffixes at places of the cover are sorted, by doubling over blocks of ``MODULUS`` words, and only in documents in which a
   match reaches such a place. The common blocks of two of them are a minimum over neighbours' common blocks: a sparse table.
4. Equal stretches found with several periods are one run: its period is the smallest, and divides the others.

All documents of a piece of text are one array with a different mark behind each, so no match leaves its document. Words and blocks
stand for their 64-bit hashes. A task holds a few numbers for each word of a mebibyte of text, or of one longer document.

A null text has no words and no runs; its collapsed text is empty. Repeated rows are separate documents. Columns but those asked for
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridmill.llm.textarrays import SPACE, Texts, chunks, mix, word_hashes

#: Any two residues of a cover meet: every difference modulo MODULUS is one of two members of COVER.
MODULUS, COVER = 13, (0, 1, 3, 9)
LEAST, TIMES = 6, 4
#: Grid places looked at together.
PLACES = 1 << 21

_U = np.uint64
_IN_COVER = np.isin(np.arange(MODULUS), COVER)
#: Words from places with the two residues to places that both are in the cover.
_STEPS = np.array([[next(t for t in range(MODULUS) if _IN_COVER[(a + t) % MODULUS] and _IN_COVER[(b + t) % MODULUS]) for b in range(MODULUS)]
                   for a in range(MODULUS)])


class CoverOrder:
    """Sorted suffixes at the covered places of some stretches of an array; blocks that two of them have in common."""

    def __init__(self, seq: np.ndarray, inside: np.ndarray):
        place = np.flatnonzero(inside)
        place = place[_IN_COVER[place % MODULUS]]
        self.slot = np.full(len(seq), -1, np.int64)
        self.slot[place] = np.arange(len(place))
        block = np.zeros(len(place), np.uint64)
        for t in range(MODULUS):
            block = mix(block * _U(0x9E3779B97F4A7C15) + seq[place + t])
        rank = np.unique(block, return_inverse=True)[1]
        ahead = self.slot[place + MODULUS]
        ranks, jumps = [rank], [ahead]
        # The mark behind a document is in no other block, so the order becomes strict at last.
        while len(rank) and int(rank.max()) + 1 < len(rank):
            follower = np.where(ahead < 0, 0, rank[ahead] + 1)
            rank = np.unique(rank * (len(rank) + 1) + follower, return_inverse=True)[1]
            ahead = np.where(ahead < 0, -1, ahead[ahead])
            ranks.append(rank)
            jumps.append(ahead)
        self.rank = rank
        order = np.empty(len(rank), np.int64)
        order[rank] = np.arange(len(rank))
        x, y = order[:-1], order[1:]
        common = np.zeros(len(x), np.int32)
        for k in range(len(ranks) - 1, -1, -1):
            same = (x >= 0) & (y >= 0) & (ranks[k][x] == ranks[k][y])
            common += same.astype(np.int32) << k
            x, y = np.where(same, jumps[k][x], x), np.where(same, jumps[k][y], y)
        self.least = [common]
        while 2 << (len(self.least) - 1) <= len(common):
            half = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))

    def blocks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Blocks that the suffixes at covered places x and y have in common, x and y different."""
        x, y = self.rank[self.slot[x]], self.rank[self.slot[y]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(x), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.least[k][low[at]], self.least[k][high[at] - (1 << k)])
        return out


def equal_words(seq: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal words from x and y on, ``most`` at most, by comparing them."""
    out = np.zeros(len(x), np.int64)
    live = np.flatnonzero(most > 0)
    t = 0
    while len(live):
        live = live[seq[x[live] + t] == seq[y[live] + t]]
        t += 1
        out[live] = t
        live = live[most[live] > t]
    return out


def extensions(seq: np.ndarray, edge: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Longest common extensions of places x and y. edge: the first place of every document, and the end."""
    need = _STEPS[x % MODULUS, y % MODULUS]
    out = equal_words(seq, x, y, need)
    synced = np.flatnonzero(out == need)
    if not len(synced):
        return out
    x, y = x[synced] + need[synced], y[synced] + need[synced]
    wanted = np.zeros(len(edge), np.int8)
    doc = np.unique(np.searchsorted(edge, np.r_[x, y], side="right") - 1)
    wanted[doc] = 1
    inside = np.zeros(len(seq), bool)
    inside[edge[0]: edge[-1]] = np.repeat(wanted[:-1], np.diff(edge)) > 0
    blocks = CoverOrder(seq, inside).blocks(x, y) * MODULUS
    out[synced] += blocks + equal_words(seq, x + blocks, y + blocks, np.full(len(x), MODULUS))
    return out


def find_runs(words: np.ndarray, size: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """Document, start, length and period of every run, by document, start and period. size: words of each document."""
    n_docs = len(size)
    pad = MODULUS + 1
    begin = pad + np.cumsum(np.r_[0, size[:-1] + 1])[:n_docs]
    total = 2 * pad + len(words) + n_docs
    seq = mix(np.arange(total, dtype=np.uint64) * _U(2) + _U(0xA5A5A5A5A5A5A5A5))  # marks: each place has its own
    seq[np.arange(len(words)) + np.repeat(begin - np.cumsum(np.r_[0, size[:-1]])[:n_docs], size)] = words
    back = seq[::-1].copy()
    edge = np.r_[begin, total - pad]
    back_edge = np.r_[(total - begin - size)[::-1], total - pad + 1]
    step = times - 1

    longest = np.where(size >= least, size // times, 0)
    doc = np.repeat(np.arange(n_docs), longest)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    places = (size[doc] - 1 - period) // (step * period) + 1
    upto = np.cumsum(places)
    found = [np.zeros((4, 0), np.int64)]
    first = 0
    while first < len(doc):
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + PLACES)))
        many = places[first:last]
        q = np.repeat(period[first:last], many)
        d = np.repeat(doc[first:last], many)
        nth = np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many)
        x = begin[d] + nth * step * q
        first = last
        same = np.flatnonzero(seq[x] == seq[x + q])
        q, d, x = q[same], d[same], x[same]
        # Of the places q apart around it, as many in a row must match as a run has at least; places beyond the document never count against it.
        alike = {k: seq[np.clip(x + k * q, 0, total - 1)] == seq[np.clip(x + (k + 1) * q, 0, total - 1)] for k in range(-step + 1, step)}
        enough = np.zeros(len(x), bool)
        for k in range(-step + 1, 1):
            enough |= np.logical_and.reduce([alike[k + j] for j in range(step)])
        q, d, x = q[enough], d[enough], x[enough]
        if not len(x):
            continue
        ahead = extensions(seq, edge, x, x + q)
        behind = extensions(back, back_edge, total - x, total - x - q)
        length = ahead + behind + q
        good = length >= np.maximum(least, times * q)
        found.append(np.stack([d[good], (x - behind - begin[d])[good], length[good], q[good]]))
    d, start, length, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, length, start, d))
    d, start, length, q = d[order], start[order], length[order], q[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    d, start, length, q = d[new], start[new], length[new], q[new]
    order = np.lexsort((q, start, d))
    return d[order], start[order], length[order], q[order]


def collapsed(texts: Texts, size: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> pa.Array:
    """Words that no run holds after its first period, joined by one space, for every document."""
    first, end, owner = texts.words()
    upto = np.cumsum(np.r_[0, size])
    change = np.zeros(len(first) + 1, np.int64)
    np.add.at(change, upto[doc] + start + period, 1)
    np.add.at(change, upto[doc] + start + length, -1)
    gone = np.cumsum(change[:-1]) > 0
    keep = ~SPACE[texts.data]
    if gone.any():
        change = np.zeros(len(texts.data) + 1, np.int64)
        change[first[gone]] += 1
        change[end[gone]] -= 1
        keep &= np.cumsum(change[:-1]) == 0
    data = texts.data.copy()
    # The byte behind a word is white space; it becomes the space behind it unless the word is its document's last.
    first, end, owner = first[~gone], end[~gone], owner[~gone]
    joint = np.zeros(len(end), bool)
    joint[:-1] = owner[1:] == owner[:-1]
    data[end[joint]] = 0x20
    keep[end[joint]] = True
    bytes_upto = np.cumsum(np.r_[0, np.bincount(owner, end - first + joint, texts.n).astype(np.int64)])
    return pa.LargeStringArray.from_buffers(texts.n, pa.py_buffer(bytes_upto), pa.py_buffer(data[keep].tobytes()))


def periodic_runs(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """key, n_words, runs (start, length and period, by start and period) and the collapsed text of every row.

    ``times`` (2 at least) is the least exponent of a run, ``least`` its least number of words.
    """
    if times < 2 or least < 1:
        raise ValueError("a run has two periods and one word at least")
    kind = docs.schema[key].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(1)):
                words, owner = word_hashes(texts, lower=False)
                size = np.bincount(owner, minlength=texts.n)
                doc, start, length, period = find_runs(words, size, least, times)
                offsets = np.searchsorted(doc, np.arange(texts.n + 1))
                parts = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
                yield pa.RecordBatch.from_pydict({
                    key: batch.column(0).slice(texts.first, texts.n), "n_words": pa.array(size, pa.int64()),
                    "runs": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts),
                    "collapsed": collapsed(texts, size, doc, start, length, period).cast(pa.string())})

    return docs.select(F.col(key), F.col(text).cast("string").alias("text")).mapInArrow(
        search, f"`{key}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
