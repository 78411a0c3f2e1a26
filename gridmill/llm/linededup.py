"""Deletes runs of lines that stand earlier in the corpus already, found by winnowing over line hashes.

A line counts by its text without white space at its ends; lines without a word are passed over. The window at a line is the
shortest run of lines from there on that has ``min_words`` words. Its fingerprint is its least line hash, the leftmost of
equals. Equal runs have equal windows, so every repeated run of ``min_words`` words shares a fingerprint: nothing is missed.
A line of ``min_words`` words is a window alone, so it goes wherever it stands again, whatever its neighbours are.

1. One pass over the texts selects the fingerprints, each with the windows it stands for. Neighbouring windows mostly share one.
2. Fingerprints that occur once are dropped by a count; positions of the others are joined.
3. A match is extended both ways window by window: windows of equal content are repeats, and all but the first in order of
   (doc_id, line) are later ones. Overlapping later windows make up one deleted run. The copy that is first stays; a window
   that overlaps its own first copy loses only the lines beyond it.

Lines go with their line end. A null text stays null, an empty one empty. Documents without a number come first, rows that share
one follow each other by content, and equal rows of one number count as one text that is given back as often. Empty tables
give no rows. Other columns of the input are kept as they are; those named like a new one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridmill.llm.textarrays import Texts, chunks, mix, prefix_sums, signed, span_hash
from gridmill.session import scratch

#: Shorter lines repeat by chance ("Les."); they go only with their neighbours.
MIN_WORDS = 4

_U = np.uint64


def windows(texts: Texts, min_words: int) -> tuple[np.ndarray, ...]:
    """Document, first and last line, content hash, fingerprint and its place for every window."""
    begin, stop, doc = texts.lines()
    word_start, word_end, _ = texts.words()
    # First and last word of every line.
    low, high = np.searchsorted(word_start, begin), np.searchsorted(word_start, stop)
    line = np.arange(len(begin)) - np.searchsorted(doc, np.arange(texts.n))[doc]
    full = np.flatnonzero(high > low)
    none = tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2)) + (np.zeros(0, np.int64),)
    if not len(full):
        return none
    doc, line, size = doc[full], line[full], (high - low)[full]
    key = span_hash(prefix_sums(texts.data), word_start[low[full]], word_end[high[full] - 1])
    total = np.r_[0, np.cumsum(size)]
    last = np.searchsorted(total, total[:-1] + min_words)  # the window is [i, last)
    ok = np.flatnonzero((last <= len(full)) & (doc[np.minimum(last, len(full)) - 1] == doc))
    if not len(ok):
        return none
    first, last = ok, last[ok]
    width = last - first
    content, least, place = np.zeros(len(ok), np.uint64), key[first], first.copy()
    for j in range(int(width.max())):  # at most min_words steps, as every line has a word
        on = j < width
        at = np.minimum(first + j, len(key) - 1)
        content = np.where(on, mix(content + key[at] + _U(j + 1)), content)
        less = on & (key[at] < least)
        least, place = np.where(less, key[at], least), np.where(less, at, place)
    return doc[first], line[first], line[last - 1], content, least, place


def later_runs(rows: DataFrame, min_words: int) -> DataFrame:
    """row, first, last (lines) of windows that repeat an earlier one; ``rows`` has doc_id, row and text."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                doc, first, last, content, print_, place = windows(texts, min_words)
                if not len(doc):
                    continue
                edge = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
                flat = pa.StructArray.from_arrays([pa.array(first), pa.array(last), pa.array(signed(content))], ["first", "last", "content"])
                take = pa.array(doc[edge])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(texts.first, texts.n).take(take), "row": batch.column("row").slice(texts.first, texts.n).take(take),
                    "print": signed(print_[edge]), "windows": pa.ListArray.from_arrays(pa.array(np.r_[edge, len(doc)], pa.int32()), flat)})

    seen = rows.select("doc_id", "row", "text").mapInArrow(
        select, "doc_id long, row long, print long, windows array<struct<first:long,last:long,content:long>>")
    # Written, so that the join below has plain shuffles on both sides and adaptive execution may cut the part of a common line.
    path = scratch(rows.sparkSession, "prints")
    seen.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print").write.parquet(path)
    shared = rows.sparkSession.read.parquet(path)
    joined = seen.join(shared, "print", "left_semi").select("doc_id", "row", F.explode("windows").alias("w")).select("doc_id", "row", "w.*").distinct()
    place = F.struct("doc_id", "row", "first", "last")
    origin = joined.groupBy("content").agg(F.min(place).alias("origin"), F.count("*").alias("n")).where("n > 1").select("content", "origin")
    later = joined.join(origin, "content").where(~(place.eqNullSafe(F.col("origin"))))
    own = F.col("row") == F.col("origin.row")
    start = F.when(own, F.greatest("first", F.col("origin.last") + 1)).otherwise(F.col("first"))
    return later.select("row", start.alias("first"), "last").where("first <= last")


def delete_repeats(docs: DataFrame, *, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with the text that is left, and n_lines, n_removed (lines) and runs (first and last line of each
    deleted run)."""
    docs = docs.drop("n_lines", "n_removed", "runs", "_row", "_runs")
    names = docs.columns
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    rows = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_row").alias("row"), "text")
    found = later_runs(rows, min_words).groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("_runs")).withColumnRenamed("row", "_row")
    joined = keyed.join(found, "_row", "left").drop("_row")

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = names.index("text")
        for batch in batches:
            texts, total, gone, runs = [], [], [], []
            for text, marks in zip(batch.column("text"), batch.column("_runs"), strict=True):
                if not text.is_valid:
                    texts.append(None)
                    total.append(0)
                    gone.append(0)
                    runs.append([])
                    continue
                if not marks.is_valid:
                    whole = text.as_py()
                    texts.append(whole)
                    total.append(whole.count("\n") + 1)
                    gone.append(0)
                    runs.append([])
                    continue
                lines = text.as_py().split("\n")
                first, last = (marks.values.field(k).to_numpy() for k in range(2))
                edge = np.zeros(len(lines) + 1, np.int64)
                np.add.at(edge, first, 1)
                np.add.at(edge, last + 1, -1)
                off = np.cumsum(edge[:-1]) > 0
                at = np.flatnonzero(np.diff(np.r_[0, off.astype(np.int8), 0]))
                texts.append("\n".join(x for x, o in zip(lines, off.tolist(), strict=True) if not o))
                total.append(len(lines))
                gone.append(int(off.sum()))
                runs.append([{"first": a, "last": b - 1} for a, b in at.reshape(-1, 2).tolist()])
            kept = [batch.column(c) for c in names]
            kept[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))],
                names=[*names, "n_lines", "n_removed", "runs"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(delete, f"{kinds}, n_lines long, n_removed long, runs array<struct<first:long,last:long>>")
