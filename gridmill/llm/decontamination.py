"""Finds benchmark items in training texts, edited copies included: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased and compared without ASCII punctuation at their ends. Seeds are the runs of ``SEED`` words of the items.
One pass over the corpus counts the words of the items. A seed is rare if words drawn by these frequencies would make it up in
fewer than ``RARE`` of the documents; so seeds stay rare however often an item itself was copied. The quarter of an item's seeds
that is least likely is used in any case. A second pass looks the rare seeds up, joins the hits of a document and an item
that stand together to passages, widens each by the length of the item, and aligns it word by word. A pair is reported if the
score reaches ``LEAST`` of the score of a verbatim copy, or that of ``PASSAGE`` consecutive words of it, however long the item is.

Items are read in blocks of at most ``BLOCK_BYTES`` of text, each broadcast in one pass over the whole corpus; so a larger
benchmark takes more passes, not more memory. The counts of a block's words are as bounded.

Items with fewer than ``SEED`` words have no seed and are not searched for. Null and empty texts match nothing. Rows that share a
number are searched each. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridmill.llm.textarrays import LOWER, Texts, chunks, prefix_sums, shingles, span_hash

SEED, LEAST = 3, 0.5
#: Words of a verbatim excerpt that are reported from an item of any length.
PASSAGE = 13
RARE = 1e-3
BLOCK_BYTES = 8 << 20
MATCH, MISMATCH, GAP = 2, -1, 1
#: Cells of a batch of alignments.
CELLS = 1 << 20

_U = np.uint64
SOLID = np.zeros(256, bool)
SOLID[[*range(48, 58), *range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True


def plain_words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word without punctuation at its ends; words of punctuation alone are passed over."""
    start, end, doc = texts.words()
    at = np.flatnonzero(SOLID[texts.data])
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    i, j = np.searchsorted(at, start), np.searchsorted(at, end)
    some = j > i
    return span_hash(prefix_sums(LOWER[texts.data]), at[i[some]], at[j[some] - 1] + 1), doc[some]


class Items:
    """Words of the items of a block, and their distinct seeds with the places where they stand."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("item_id").to_pylist()
        self.words: list[np.ndarray] = []
        for texts in chunks(table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())):
            word, doc = plain_words(texts)
            edge = np.searchsorted(doc, np.arange(texts.n + 1))
            self.words += [word[a:b] for a, b in zip(edge, edge[1:], strict=False)]
        seeds = [shingles(w, np.zeros(len(w), np.int64), SEED)[0] for w in self.words]
        self.owner = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        every = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        self.seed, self.which = np.unique(every, return_inverse=True)
        self.word = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, np.uint64)
        parts = [np.searchsorted(self.word, w) for w in self.words]
        runs = [np.stack([w[j: len(w) - SEED + 1 + j] for j in range(SEED)], axis=1) for w in parts if len(w) >= SEED]
        #: Words of every seed of every item, as numbers.
        self.made_of = np.concatenate(runs) if runs else np.zeros((0, SEED), np.int64)
        self._index(np.ones(len(every), bool))

    def _index(self, used: np.ndarray) -> None:
        """Items of every seed, as far as the seed is used for them, and a table that tells most other hashes off."""
        which, owner = self.which[used], self.owner[used]
        pairs = np.unique(which * len(self.words) + owner) if len(self.words) else np.zeros(0, np.int64)
        self.items = pairs % max(1, len(self.words))
        self.edge = np.searchsorted(pairs // max(1, len(self.words)), np.arange(len(self.seed) + 1))
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.seed[np.diff(self.edge) > 0] >> _U(42)).astype(np.int64)] = True

    def count(self, word: np.ndarray) -> np.ndarray:
        """How often each word of the items occurs in ``word``."""
        if not len(self.word):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.word, word), len(self.word) - 1)
        return np.bincount(at[self.word[at] == word], minlength=len(self.word))

    def keep_rare(self, n: np.ndarray, words: int, documents: int) -> None:
        """Leaves of every item the rare seeds, from the counts of its words in all documents."""
        by_chance = np.log(np.maximum(n, 0.5) / max(words, 1))[self.made_of].sum(axis=1) + np.log(max(words, 1) / max(documents, 1))
        used = by_chance <= np.log(RARE)
        edge = np.searchsorted(self.owner, np.arange(len(self.words) + 1))
        for a, b in zip(edge, edge[1:], strict=False):
            if b > a:
                used[a:b] |= by_chance[a:b] <= np.quantile(by_chance[a:b], 0.25, method="higher")
        self._index(used)

    def hits(self, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``seed`` of hashes that are seeds, and which."""
        at = np.flatnonzero(self.maybe[(seed >> _U(42)).astype(np.int64)])
        if not len(at):
            return at, at
        which = np.minimum(np.searchsorted(self.seed, seed[at]), len(self.seed) - 1)
        same = self.seed[which] == seed[at]
        return at[same], which[same]


def align(regions: list[np.ndarray], item: np.ndarray) -> list[tuple[int, int, int]]:
    """Best local alignment score of each region with the item, and the words [start, end) of the region that it spans."""
    longest = max(len(r) for r in regions)
    text = np.zeros((len(regions), longest), np.uint64)
    inside = np.zeros(text.shape, bool)
    for row, on, r in zip(text, inside, regions, strict=True):
        row[: len(r)] = r
        on[: len(r)] = True
    n = longest + 1
    score, begin = np.zeros((len(regions), n), np.int64), np.tile(np.arange(n), (len(regions), 1))
    best, start, end = (np.zeros(len(regions), np.int64) for _ in range(3))
    slope = GAP * np.arange(n)
    place = np.arange(n)
    every = np.arange(len(regions))
    for word in item:
        step = np.where((text == word) & inside, MATCH, MISMATCH)
        now = np.maximum(score - GAP, 0)
        origin = np.where(score > GAP, begin, place)
        across = score[:, :-1] + step
        better = across > now[:, 1:]
        now[:, 1:] = np.where(better, across, now[:, 1:])
        origin[:, 1:] = np.where(better, begin[:, :-1], origin[:, 1:])
        # Gaps along the region: the best of all cells to the left, each less its distance. Cell and value share one number.
        reach = np.maximum.accumulate((now + slope) * n + (n - 1 - place), axis=1)
        source = n - 1 - reach % n
        value = reach // n - slope
        wins = value > now
        score = np.where(wins, value, now)
        begin = np.where(wins, np.take_along_axis(origin, source, axis=1), origin)
        begin = np.where(score > 0, begin, place)
        column = score.argmax(axis=1)
        top = score[every, column]
        more = top > best
        best[more], start[more], end[more] = top[more], begin[every, column][more], column[more]
    return list(zip(best.tolist(), start.tolist(), end.tolist(), strict=True))


def passages(texts: Texts, items: Items) -> Iterator[tuple[int, int, float, int, int]]:
    """Document, item, share of the verbatim score, and words [start, end) of the best passage of every pair found."""
    word, doc = plain_words(texts)
    seed, at = shingles(word, doc, SEED)
    hit, which = items.hits(seed)
    n = items.edge[which + 1] - items.edge[which]
    place = np.repeat(at[hit], n)
    item = items.items[np.repeat(items.edge[which] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())] if len(n) else np.zeros(0, np.int64)
    if not len(place):
        return
    first_word = np.searchsorted(doc, np.arange(texts.n + 1))
    owner = doc[place]
    order = np.lexsort((place, owner, item))
    place, item, owner = place[order], item[order], owner[order]
    size = np.array([len(w) for w in items.words])
    new = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] - place[:-1] > 2 * size[item[1:]])])
    last = np.r_[new[1:] - 1, len(place) - 1]
    todo: dict[int, list[tuple[int, int, int]]] = {}
    for k, d, a, b in zip(item[new].tolist(), owner[new].tolist(), place[new].tolist(), place[last].tolist(), strict=True):
        todo.setdefault(k, []).append((d, max(int(first_word[d]), a - int(size[k])), min(int(first_word[d + 1]), b + SEED + int(size[k]))))
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    for k, regions in todo.items():
        regions.sort(key=lambda r: r[2] - r[1])
        while regions:
            take = 1
            while take < len(regions) and (take + 1) * (regions[take][2] - regions[take][1]) <= CELLS // 8:
                take += 1
            part, regions = regions[:take], regions[take:]
            for (d, a, _), (top, start, end) in zip(part, align([word[a:b] for _, a, b in part], items.words[k]), strict=True):
                share = top / (MATCH * len(items.words[k]))
                if (share >= LEAST or top >= MATCH * PASSAGE) and share > found.get((d, k), (0.0,))[0]:
                    found[d, k] = share, a + start - int(first_word[d]), a + end - int(first_word[d])
    for (d, k), rest in sorted(found.items()):
        yield d, k, *rest


def rare_blocks(docs: DataFrame, benchmark: DataFrame) -> Iterator:
    """The items in blocks with their rare seeds, each broadcast; one pass over ``docs`` counts the words of a block."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 if total <= BLOCK_BYTES else -(-2 * total // BLOCK_BYTES)
    for b in range(blocks):
        block = Items(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").toArrow())
        held = spark.sparkContext.broadcast(block)

        def count(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            seen, words, documents = np.zeros(len(held.value.word), np.int64), 0, 0
            for batch in batches:
                for texts in chunks(batch.column(0)):
                    word, _ = plain_words(texts)
                    seen += held.value.count(word)
                    words, documents = words + len(word), documents + texts.n
            some = np.flatnonzero(seen)
            yield pa.RecordBatch.from_pydict({"word": np.r_[some, -1, -2], "n": np.r_[seen[some], words, documents]})

        counted = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
        # The last two places take the numbers of all words and documents.
        n = np.zeros(len(block.word) + 2, np.int64)
        n[counted.column("word").to_numpy()] = counted.column("n").to_numpy()
        block.keep_rare(n[:-2], int(n[-1]), int(n[-2]))
        yield spark.sparkContext.broadcast(block)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score (share of a verbatim copy's), word_start and word_end of every contaminated pair."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = []
    for rare in rare_blocks(docs, benchmark):

        def search(batches: Iterator[pa.RecordBatch], rare=rare) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for texts in chunks(batch.column(1)):
                    rows = list(passages(texts, rare.value))
                    if rows:
                        d, k, share, start, end = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": batch.column(0).slice(texts.first, texts.n).take(pa.array(d)), "item_id": pa.array([rare.value.ids[i] for i in k], pa.int64()),
                            "score": pa.array(share), "word_start": pa.array(start, pa.int64()), "word_end": pa.array(end, pa.int64())})

        found.append(docs.mapInArrow(search, "doc_id long, item_id long, score double, word_start long, word_end long"))
    return reduce(DataFrame.unionByName, found)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, all columns as they are."""
    kept = docs
    for rare in rare_blocks(docs, benchmark):

        def drop(batches: Iterator[pa.RecordBatch], rare=rare) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                whole = np.ones(batch.num_rows, bool)
                for texts in chunks(batch.column("text")):
                    whole[[texts.first + d for d, *_ in passages(texts, rare.value)]] = False
                yield batch.filter(pa.array(whole))

        kept = kept.mapInArrow(drop, docs.schema)
    return kept
