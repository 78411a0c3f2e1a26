"""Exact removal of byte strings that occur more than once, by a distributed merge sort of front-coded suffix runs.

A byte goes if it is covered by a string of ``length`` bytes that also starts anywhere else; matches never cross documents.

Sorting every suffix is not needed to decide this. Each string of ``length`` bytes has an anchor: the leftmost of the least
hashed ``GRAM``-byte strings in it. Equal strings have their anchors at the same place, so the starts of a document fall
into runs, one per anchor, and only anchors whose ``GRAM`` bytes occur twice can stand for a repeat.

1. One pass over the texts finds the anchors, the range of starts of each, and a hash of all bytes that its strings touch.
   Counting the hashes of the anchors leaves those that occur twice.
2. Anchors with equal surroundings become one, with their count, so a group of copies or a common passage travels once.
3. Each is cut into ``STEP`` starts at most. A task takes the suffixes at the first start of each, sorts them and writes runs:
   of each suffix only what differs from the one before. Runs are exchanged by a hash of the bytes that all starts share.
4. A loser tree merges the runs of a group. It keeps, for every run's head, the length of the prefix it shares with the last
   string put out; the longer prefix wins, and bytes are compared only from a known common prefix on.
5. Suffixes that share enough bytes are neighbours then. Together with the few bytes before them they tell for every start
   whether its string occurs again. Spans go back to the documents.

A null text is empty. Rows that share a document number are separate texts. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridmill.llm.textarrays import Texts, chunks, mix, prefix_sums, signed, span_hash
from gridmill.session import scratch

LENGTH, GRAM, STEP = 400, 100, 67
#: Surroundings merged in one group on average, and bytes of suffixes sorted in one run.
PER_GROUP, RUN_BYTES = 20_000, 32 << 20

_U = np.uint64
ITEM = np.dtype([("shared", "<u4"), ("tail", "<u4"), ("left", "<u2"), ("e0", "<u2"), ("e1", "<u2"), ("a", "<u2"), ("n", "<i8"), ("c", "<i8")])


def anchors(texts: Texts, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Document, position, least and greatest distance back to a start, hash of the anchor, hash of all it touches."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    wide = length - gram + 1
    n = len(texts.data) - gram + 1
    if n < wide or int(texts.size.max(initial=0)) < length:
        return none
    sums = prefix_sums(texts.data)
    at = np.arange(n)
    value = span_hash(sums, at, at + gram)
    # Equal upper halves are told apart by position, so the leftmost wins.
    key = (value & _U(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    padded = np.full(-(-n // wide) * wide + wide, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    block = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - wide + 1
    least = np.minimum(behind[:starts], ahead[wide - 1: wide - 1 + starts])
    # Starts whose string ends within their document.
    room = np.maximum(texts.size - length + 1, 0)
    first = np.repeat(texts.start - np.r_[0, np.cumsum(room)[:-1]], room)
    start = first + np.arange(len(first))
    doc = np.repeat(np.arange(texts.n), room)
    place = (least[start] & _U(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])])
    last = np.r_[edge[1:] - 1, len(place) - 1]
    p, lo, hi = place[edge], start[edge], start[last]
    touched = span_hash(sums, lo, hi + length)
    return doc[edge], p - texts.start[doc[edge]], p - hi, p - lo, value[p], mix(touched + mix((p - lo).astype(np.uint64) << _U(20) | (p - hi).astype(np.uint64)) + value[p])


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that agree on ``known`` bytes."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return n - (int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() // 8 - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() % 8 > 0)


def front_coded(items: list[tuple]) -> bytes:
    """A sorted run of (suffix, left, e0, e1, a, n, c): records, then what each suffix has beyond the one before, then lefts."""
    head = np.zeros(len(items), ITEM)
    tails, before = [], b""
    for row, (suffix, left, e0, e1, a, n, c) in zip(head, items, strict=True):
        k = shared(before, suffix)
        tails.append(suffix[k:])
        row["shared"], row["tail"], row["left"], row["e0"], row["e1"], row["a"], row["n"], row["c"] = k, len(suffix) - k, len(left), e0, e1, a, n, c
        before = suffix
    return len(items).to_bytes(8, "little") + head.tobytes() + b"".join(tails) + b"".join(i[1] for i in items)


class Run:
    """Reads a front-coded run item by item."""

    def __init__(self, blob: bytes):
        n = int.from_bytes(blob[:8], "little")
        self.head = np.frombuffer(blob, ITEM, n, 8)
        self.blob, self.at = blob, 8 + n * ITEM.itemsize
        edge = np.r_[0, np.cumsum(self.head["left"], dtype=np.int64)]
        base = self.at + int(self.head["tail"].sum(dtype=np.int64))
        self.lefts = [blob[base + x: base + y] for x, y in zip(edge, edge[1:], strict=False)]
        self.known, self.tail = self.head["shared"].tolist(), self.head["tail"].tolist()
        self.i, self.now = -1, b""

    def advance(self) -> int:
        """Goes to the next suffix; the length of the prefix it shares with the one before, or -1 at the end."""
        self.i += 1
        if self.i == len(self.known):
            return -1
        k, t = self.known[self.i], self.tail[self.i]
        self.now = self.now[:k] + self.blob[self.at: self.at + t]
        self.at += t
        return k


def merged(runs: list[Run]) -> Iterator[tuple[int, int, int]]:
    """(run, item, prefix shared with the item put out before) of all runs in sorted order, by a loser tree."""
    k = 1
    while k < len(runs):
        k *= 2
    known = [r.advance() for r in runs] + [-1] * (k - len(runs))

    def beats(i: int, j: int) -> bool:
        """Whether head i comes first. The loser keeps the prefix that it shares with the winner."""
        if known[i] != known[j]:
            return known[i] > known[j]
        if known[i] < 0:
            return True
        x, y = runs[i].now, runs[j].now
        both = shared(x, y, known[i])
        first = both == len(x) or both < len(y) and x[both] < y[both]
        known[j if first else i] = both
        return first

    loser = [0] * (2 * k)
    winner = [0] * (2 * k)
    for leaf in range(k):
        winner[k + leaf] = leaf
    for node in range(k - 1, 0, -1):
        i, j = winner[2 * node], winner[2 * node + 1]
        winner[node], loser[node] = (i, j) if beats(i, j) else (j, i)
    best = winner[1] if k > 1 else 0
    while known[best] >= 0:
        yield best, runs[best].i, known[best]
        # What the run shares with its own last item, just put out, is stored in it.
        known[best] = runs[best].advance()
        node = (best + k) // 2
        while node:
            if not beats(best, loser[node]):
                best, loser[node] = loser[node], best
            node //= 2


def repeats(blobs: list[bytes], length: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Surroundings with the least and greatest distance of starts whose string occurs twice, one row per stretch."""
    runs = [Run(b) for b in blobs]
    order = list(merged(runs))
    head = np.concatenate([r.head for r in runs])
    base = np.r_[0, np.cumsum([len(r.head) for r in runs])]
    item = np.array([base[r] + i for r, i, _ in order], np.int64)
    common = np.array([k for _, _, k in order], np.int64)
    common[0] = 0
    lefts = [x for r in runs for x in r.lefts]
    head, lefts = head[item], [lefts[i] for i in item.tolist()]
    m = len(head)
    before = np.zeros((m, step), np.uint8)
    size = head["left"].astype(np.int64)
    flat = np.frombuffer(b"".join(lefts), np.uint8)
    row = np.repeat(np.arange(m), size)
    back = np.repeat(np.cumsum(size), size) - np.arange(len(flat)) - 1  # 0 is the byte right before the suffix
    before[row, back] = flat
    found = np.zeros((m, step), bool)
    left = np.zeros(m, np.uint64)
    for e in range(step):
        if e:
            left = mix(left * _U(257) + before[:, e - 1] + _U(1))
        own = np.flatnonzero((head["e0"] <= e) & (e <= head["e1"]))
        if not len(own):
            continue
        group = np.cumsum(common < length - e)
        key = mix(left[own] * _U(0x9E3779B97F4A7C15) + group[own].astype(np.uint64))
        sort = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.r_[True, key[sort][1:] != key[sort][:-1]])
        total = np.add.reduceat(head["n"][own][sort], first)
        again = np.repeat(total > 1, np.diff(np.r_[first, len(sort)]))
        found[own[sort[again]], e] = True
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    (row, d1), (_, d2) = np.nonzero(edge == 1), np.nonzero(edge == -1)
    a = head["a"][row].astype(np.int64)
    return head["c"][row], a + d1, a + d2 - 1


def as_text(kept: str) -> Column:
    """What is left as text. A cut may fall inside a character; what is left of it shows as the replacement character."""
    return F.make_valid_utf8(F.col(kept).cast("string"))


def removed(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, step: int = STEP) -> DataFrame:
    """doc_id, n_bytes, spans (start and end of maximal removed runs) and kept (remaining bytes) for every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = docs.withColumn("row", F.xxhash64("doc_id", "text"))

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(1)):
                doc, pos, lo, hi, g, c = anchors(texts, length, gram)
                if len(doc):
                    yield pa.RecordBatch.from_pydict({
                        "row": batch.column(0).slice(texts.first, texts.n).take(pa.array(doc)), "pos": pos, "lo": pa.array(lo, pa.int32()),
                        "hi": pa.array(hi, pa.int32()), "g": signed(g), "c": signed(c)})

    seen = keyed.select("row", "text").mapInArrow(find, "row long, pos long, lo int, hi int, g long, c long")
    # Written, so that the join below has plain shuffles on both sides and adaptive execution may cut the part of a common passage.
    twice = stored(seen.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "twice")
    open_ = stored(seen.join(twice, "g", "left_semi").select("row", "pos", "lo", "hi", "c"), "anchors")
    around = open_.groupBy("c").agg(F.count("*").alias("n"), F.min(F.struct("row", "pos", "lo", "hi")).alias("at"))
    around = stored(around.select("c", "n", "at.*"), "surroundings")
    groups = max(1, -(-around.count() // PER_GROUP))

    def sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[tuple] = []
        held = 0

        def runs() -> Iterator[pa.RecordBatch]:
            items.sort(key=lambda x: x[:2])
            begin = 0
            for i in range(1, len(items) + 1):
                if i == len(items) or items[i][0] != items[begin][0]:
                    yield pa.RecordBatch.from_pydict({"part": pa.array([items[begin][0]], pa.int32()), "run": [front_coded([x[1:] for x in items[begin:i]])]})
                    begin = i

        for batch in batches:
            for text, picked in zip(batch.column("text"), batch.column("picked"), strict=True):
                data = text.as_buffer().to_pybytes()
                for x in picked.as_py():
                    for j in range(x["lo"] // step, x["hi"] // step + 1):
                        a = j * step
                        e0, e1, q = max(x["lo"] - a, 0), min(x["hi"] - a, step - 1), x["pos"] - a
                        suffix = data[q: q + length - e0]
                        part = zlib.crc32(data[q: q + length - step + 1]) % groups
                        items.append((part, suffix, data[q - e1: q], e0, e1, a, x["n"], x["c"]))
                        held += len(suffix) + 200
                if held > RUN_BYTES:
                    yield from runs()
                    items.clear()
                    held = 0
        yield from runs()

    def merge(table: pa.Table) -> pa.Table:
        c, d1, d2 = repeats(table.column("run").to_pylist(), length, step)
        return pa.table({"c": c, "d1": pa.array(d1, pa.int32()), "d2": pa.array(d2, pa.int32())})

    picked = around.groupBy("row").agg(F.collect_list(F.struct("pos", "lo", "hi", "n", "c")).alias("picked"))
    texts = keyed.select("row", "text").join(picked, "row").dropDuplicates(["row"])
    found = texts.select("text", "picked").mapInArrow(sort_runs, "part int, run binary").groupBy("part").applyInArrow(
        merge, "c long, d1 int, d2 int")
    spans = stored(open_.select("row", "pos", "c").join(found, "c").groupBy("row").agg(
        F.collect_list(F.struct((F.col("pos") - F.col("d2")).alias("start"), (F.col("pos") - F.col("d1") + length).alias("end"))).alias("found")), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, marks, kept = [], [], []
            found = batch.column("found")
            for i, text in enumerate(batch.column("text")):
                data = text.as_buffer()
                size.append(data.size)
                if not found[i].is_valid:
                    marks.append([])
                    kept.append(data.to_pybytes())
                    continue
                pairs = found[i].values
                start, end = (pairs.field(k).to_numpy() for k in range(2))
                order = np.argsort(start, kind="stable")
                start, end = start[order], np.maximum.accumulate(end[order])
                new = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
                start, end = start[new], end[np.r_[new[1:] - 1, len(end) - 1]]
                marks.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist(), strict=True)])
                edge = np.r_[0, end, data.size]
                raw = data.to_pybytes()
                kept.append(b"".join(raw[a:b] for a, b in zip(edge[:-1].tolist(), np.r_[start, data.size].tolist(), strict=True)))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_bytes": pa.array(size, pa.int64()),
                "spans": pa.array(marks, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.binary())})

    return keyed.join(spans, "row", "left").select("doc_id", "text", "found").mapInArrow(
        cut, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
