"""Quality rules and an isolation forest over their statistics.

Rule statistics are counted over whole texts in arrays. The forest isolates a document by random splits of its
statistics: a short mean path is an odd document. Each tree grows on its own few labelled good rows, as the method has
it; the length of path below which a document goes is set from all labelled rows.

A null text has no word and fails the base rules, as does any text of fewer than ten words. Without labels of both
kinds nothing but the base rules removes rows. Repeated rows are judged alike. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from gridmill.llm.textarrays import SPACE, Texts, chunks, counts_by, marked_runs, prefix_sums, repeated, shingles, span_hash
from gridmill.session import checkpointed

#: Trees, and the good rows that one of them grows on.
TREES, SUBSAMPLE = 128, 256
#: Share of good labelled rows that the threshold may remove.
MAX_GOOD_LOST = 0.003
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"): ord("Z") + 1] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!?;:,.()[]{}/\\\"'-_=+~@^`")] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[list(b"!?")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = ("symbol_share", "dup_line_share", "repeat_share", "word_length", "upper_share", "punct_share", "shout_share",
          "letterless_share")


def statistics(texts: Texts) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Counts per document, and the statistics that the forest sees [document, SHARES]."""
    n, data = texts.n, texts.data
    start, end, doc = texts.words()
    sums = prefix_sums(data)
    word = span_hash(sums, start, end)

    def per_doc(flag: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flag, out=total[1:])
        return total[texts.end] - total[texts.start]

    in_words = ~SPACE[data]
    n_words = counts_by(doc, n)
    chars = per_doc(in_words & ((data & 0xC0) != 0x80))
    window, at = shingles(word, doc, WINDOW)
    owner = doc[at] if len(at) else np.zeros(0, np.int64)
    own = np.uint64(0x9E3779B97F4A7C15) * (owner.astype(np.uint64) + np.uint64(1))
    twice = repeated(window ^ own)
    covered = marked_runs(at[twice], WINDOW, len(word)) if len(word) else np.zeros(0, bool)
    repeat = counts_by(doc[covered], n)

    begin, stop, of = texts.lines()
    spaces = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_words, out=spaces[1:])
    filled = spaces[stop] > spaces[begin]
    begin, stop, of = begin[filled], stop[filled], of[filled]
    key = span_hash(sums, begin, stop) ^ (np.uint64(0x9E3779B97F4A7C15) * (of.astype(np.uint64) + np.uint64(1)))
    _, earliest = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[earliest] = False
    dup_lines = counts_by(of[again], n)
    lines = counts_by(of, n)
    counts = {"n_words": n_words, "word_chars": chars, "n_symbols": per_doc(_SYMBOLS[data]), "n_dup_lines": dup_lines, "n_repeat_words": repeat}
    w, c = np.maximum(n_words, 1), np.maximum(chars, 1)
    letters = np.maximum(per_doc(_LETTER[data]), 1)
    lettered = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTER[data], out=lettered[1:])
    letterless = counts_by(doc[lettered[end] == lettered[start]], n)
    shares = np.column_stack([
        counts["n_symbols"] / c, dup_lines / np.maximum(lines, 1), repeat / w, np.minimum(chars / w, 40) / 40,
        per_doc(_UPPER[data]) / letters, per_doc(_PUNCT[data]) / c, per_doc(_SHOUT[data]) / c, letterless / w])
    return counts, shares


class Forest:
    """Isolation trees in arrays: node 0 is the root, leaves have no children and hold their path length.

    Splits are drawn over the box of values that all labelled rows span, not only over the range of the rows in a node.
    So a statistic that is the same in all good rows still cuts off rows where it differs.
    """

    def __init__(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.expected = _path(min(subsample, len(rows)))
        self.trees = []
        for _ in range(trees):
            pick = rng.choice(len(rows), min(subsample, len(rows)), replace=False)
            nodes: list[list[float]] = []
            self._grow(rows[pick], low.copy(), high.copy(), 0, 2 * int(np.ceil(np.log2(max(2, len(pick))))), rng, nodes)
            self.trees.append(np.array(nodes))

    def _grow(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, limit: int, rng, nodes: list) -> int:
        me = len(nodes)
        nodes.append([-1, 0, 0, 0, depth + _path(len(rows))])
        wide = np.flatnonzero(high > low)
        if depth < limit and len(rows) > 1 and len(wide):
            k = int(rng.choice(wide))
            cut = rng.uniform(low[k], high[k])
            below, above = high.copy(), low.copy()
            below[k] = above[k] = cut
            left = self._grow(rows[rows[:, k] < cut], low, below, depth + 1, limit, rng, nodes)
            right = self._grow(rows[rows[:, k] >= cut], above, high, depth + 1, limit, rng, nodes)
            nodes[me] = [k, cut, left, right, 0]
        return me

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; larger is easier to isolate."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for tree in self.trees:
            node = np.zeros(len(rows), np.int64)
            while True:
                k = tree[node, 0].astype(np.int64)
                going = k >= 0
                if not going.any():
                    break
                left = rows[every, np.maximum(k, 0)] < tree[node, 1]
                node = np.where(going, np.where(left, tree[node, 2], tree[node, 3]), node).astype(np.int64)
            total += tree[node, 4]
        return 2.0 ** (-total / len(self.trees) / max(self.expected, 1e-9))


def _path(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the rules, and the statistics as an array, for every row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(1)):
                counts, shares = statistics(texts)
                flat = pa.array(shares.ravel())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(texts.first, texts.n), **{k: pa.array(v.astype(np.int64)) for k, v in counts.items()},
                    "shares": pa.ListArray.from_arrays(pa.array(np.arange(texts.n + 1, dtype=np.int32) * len(SHARES)), flat)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        measure, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", shares array<double>")


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def fit(rows: DataFrame, labels: DataFrame, *, max_good_lost: float = MAX_GOOD_LOST) -> tuple[Forest | None, float]:
    """A forest and the score above which a document goes. ``rows`` are measured documents.

    A tree grows on its own ``SUBSAMPLE`` good rows, as the method has it; they are dealt from as many rows, in order of a hash
    of the id, as all trees take. The box of values, the scores and the threshold are those of all labelled rows.
    """
    one = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    known = (rows.where(~base_failed()).select("doc_id", "shares").join(one, "doc_id").dropDuplicates(["doc_id"])
             .select("doc_id", (F.col("quality") > 0).alias("good"), "shares").persist(StorageLevel.MEMORY_AND_DISK))
    try:
        sides = [F.array(*[side(F.col("shares")[k]) for k in range(len(SHARES))]) for side in (F.min, F.max)]
        n_good, n_bad, low, high = known.agg(F.count_if("good"), F.count_if(~F.col("good")), *sides).first()
        if n_good < 2 or not n_bad:
            return None, 1.0
        picked = known.where("good").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TREES * SUBSAMPLE).select("shares").toArrow()
        shares = np.array(picked.column("shares").to_pylist())
        shares = shares[np.lexsort(shares.T)]  # the same forest in whatever order the rows arrive
        forest = Forest(shares, np.array(low), np.array(high))
        return forest, _threshold(scored(known, forest, "doc_id long, good boolean"), n_good, n_bad, max_good_lost)
    finally:
        known.unpersist()


def _threshold(rows: DataFrame, n_good: int, n_bad: int, max_good_lost: float) -> float:
    """The score whose larger ones take most bad rows less good ones, in shares, and at most so many good ones; the least of equals.

    Levels are cut into ranges of scores; how many rows lie above a range is one pair of numbers for each.
    """
    levels = rows.groupBy("anomaly").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    # The range of a level must not change when a task is run again.
    cut = checkpointed(levels.repartitionByRange("anomaly").withColumn("part", F.spark_partition_id()))
    sums = cut.groupBy("part").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("anomaly").alias("top")).collect()
    sums.sort(key=lambda r: -r["top"])
    above, good, bad = {}, 0, 0
    for r in sums:
        above[r["part"]] = good, bad
        good, bad = good + r["good"], bad + r["bad"]

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("anomaly")
        more = [after + frame[k].sum() - frame[k].cumsum() for k, after in zip(("good", "bad"), above[frame["part"].iloc[0]])]
        lost, caught = more[0] / n_good, more[1] / n_bad
        gain = np.where(lost <= max_good_lost, caught - lost, -1.0)
        at = int(gain.argmax())
        return pd.DataFrame({"gain": [gain[at]], "level": [frame["anomaly"].iloc[at]]})

    found = cut.groupBy("part").applyInPandas(best, "gain double, level double").collect()
    return min(found, key=lambda r: (-r["gain"], r["level"]))["level"]


def scored(rows: DataFrame, forest: Forest, schema: str) -> DataFrame:
    """Rows, whose columns are those of the schema and the statistics, with the forest's score instead of the statistics."""
    held = rows.sparkSession.sparkContext.broadcast(forest)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("shares").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(SHARES))
            kept = batch.drop_columns(["shares"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(held.value.score(flat))], names=[*kept.schema.names, "anomaly"])

    return rows.mapInArrow(score, f"{schema}, anomaly double")


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, the counts, base_failed, anomaly (the forest's score) and kept for every row."""
    found = measured(docs)
    forest, limit = fit(found, labels, **options)
    rows = found.withColumn("base_failed", base_failed())
    if forest is None:
        return rows.withColumn("anomaly", F.lit(0.0)).withColumn("kept", ~F.col("base_failed")).drop("shares")
    judged = scored(rows, forest, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean")
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= limit))
