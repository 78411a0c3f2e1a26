"""Exact ranked lexical search by a dual tree over items and documents.

A score is a sum over an item's terms of the term's weight times the term's value in the document, all integers that are not
negative. So with the greatest weights of a group of items and the greatest values of a group of documents, the same sum is a bound
for all pairs of the two groups.

1. One pass over the texts counts each document's terms and keeps those that occur in items. Weights need the number of documents,
   their terms in all, and in how many each of the items' terms stands: plain aggregates of what was kept.
2. Documents of a batch and all items are put into binary trees, halved at the median along the principal direction of a few hashed
   coordinates, in which frequent terms count most: so texts of one language and topic share their nodes. A node holds the greatest
   value of each of its terms.
3. Pairs of nodes are walked from the roots down. A pair whose bound is below the weakest k-th score of its items goes as a whole.
   What is left at the leaves is multiplied out, most promising documents first, and raises the k-th scores for all that follows.
4. The k-th scores of a first pass over one document in ``FIRST`` are bounds that hold for all; with them the pass over all documents
   starts, and each task gives no more than its own k best rows of an item that reach the bound. Spark ranks what the tasks gave.

Terms stand for their 64-bit hashes. Items are taken in groups of at most about ``GROUP`` terms with repeats: only these go to all
tasks (16 bytes a term and weight). A task holds one batch of documents of at most ``BATCH`` rows and ``ENTRIES`` term values, and
the values of one batch of items (``COLUMNS`` terms, or one longer item). Products are summed in doubles below 2**53.

A null text has no terms. Documents without terms are not counted and not found. Repeated documents are documents of their own and
are counted so; repeated items are ranked each on its own; documents without a number are ranked, after their equals. Empty tables give no rows.
Columns but number and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridmill.llm.textarrays import LOWER, Texts, chunks, mix, prefix_sums, span_hash
from gridmill.session import scratch

GROUP, BATCH, ENTRIES, ITEMS, COLUMNS = 1 << 20, 4096, 1 << 21, 256, 1 << 14
#: Documents and items of a leaf, hashed coordinates by which trees are cut, share of the documents of the first pass.
LEAF, ITEM_LEAF, SKETCH, FIRST = 8, 1, 64, 64
#: Steps towards the principal direction.
STEPS = 6
#: Products of so many terms are summed in doubles without loss: weight and value stay below 2**36.
EXACT = 1 << 16

TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
NO_NUMBER = np.iinfo(np.int64).max
_U = np.uint64


def terms_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every term. Terms are runs of ASCII letters and digits and of all characters beyond ASCII."""
    inside = np.zeros(len(texts.data) + 2, bool)
    inside[1:-1] = TERM[texts.data]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    return span_hash(prefix_sums(LOWER[texts.data]), start, end), texts.documents_of(start)


class Vocabulary:
    """Sorted hashes of the items' terms; most other terms are turned away by one look at a table of bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.bits = max(16, int(len(hashes)).bit_length() + 5)
        self.there = np.zeros(1 << self.bits, bool)
        self.there[hashes >> _U(64 - self.bits)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of those hashes that are known, and which they are."""
        at = np.flatnonzero(self.there[hashes >> _U(64 - self.bits)])
        if not len(self.hashes):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        known = self.hashes[place] == hashes[at]
        return at[known], place[known]


class Rows:
    """Sparse rows of term numbers and values."""

    def __init__(self, edge: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.edge, self.term, self.value, self.n = edge, term, value, len(edge) - 1

    def take(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.edge)[rows]
        edge = np.r_[0, np.cumsum(size)]
        at = np.arange(edge[-1]) + np.repeat(self.edge[:-1][rows] - edge[:-1], size)
        return Rows(edge, self.term[at], self.value[at])

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.edge))

    def sketch(self, weight: np.ndarray) -> np.ndarray:
        """Values over weights added up in a few hashed coordinates with hashed signs: rows that share terms are near each other."""
        h = mix(self.term.astype(np.uint64) + _U(77))
        side = np.where(h >> _U(63), 1.0, -1.0) * self.value / np.maximum(weight[self.term], 1)
        return np.bincount(self.owner() * SKETCH + (h % _U(SKETCH)).astype(np.int64), side, self.n * SKETCH).reshape(self.n, SKETCH)


def along(points: np.ndarray) -> np.ndarray:
    """Places of points along the direction in which they differ most, by power iteration."""
    points = points - points.mean(axis=0)
    way = 1 + np.arange(points.shape[1]) / points.shape[1]
    for _ in range(STEPS):
        way = points.T @ (points @ way)
        way /= max(float(np.linalg.norm(way)), 1e-300)
    return points @ way


def halved(points: np.ndarray, leaf: int) -> np.ndarray:
    """An order of the points, padded with -1, in which aligned pieces of leaf, 2 * leaf, 4 * leaf, ... points are nodes of a tree."""
    levels = max(0, math.ceil(math.log2(max(1, len(points)) / leaf)))
    nodes = [np.arange(len(points))]
    for _ in range(levels):
        below = []
        for rows in nodes:
            if len(rows) > 1:
                rows = rows[np.argsort(along(points[rows]), kind="stable")]
            below += [rows[: (len(rows) + 1) // 2], rows[(len(rows) + 1) // 2:]]
        nodes = below
    out = np.full(len(nodes) * leaf, -1, np.int64)
    for i, rows in enumerate(nodes):
        out[i * leaf: i * leaf + len(rows)] = rows
    return out


def greatest(rows: Rows, node: np.ndarray, n: int, columns: int, column: np.ndarray) -> np.ndarray:
    """Greatest value of every column (of terms that have one) over the rows of each node."""
    at = column[rows.term]
    has = at >= 0
    out = np.zeros(n * columns)
    np.maximum.at(out, node[rows.owner()[has]] * columns + at[has], rows.value[has].astype(np.float64))
    return out.reshape(n, columns)


def upward(leaves: np.ndarray) -> list[np.ndarray]:
    """Nodes of all levels, root first: a node holds the greater of its two children's values."""
    levels = [leaves]
    while len(levels[0]) > 1:
        levels.insert(0, np.maximum(levels[0][::2], levels[0][1::2]))
    return levels


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b as integers."""
    out = np.zeros((len(a), len(b)), np.int64)
    for first in range(0, a.shape[1], EXACT):
        out += (a[:, first: first + EXACT] @ b[:, first: first + EXACT].T).astype(np.int64)
    return out


class ItemBatch:
    """A tree of items over the terms that stand in them."""

    def __init__(self, numbers: np.ndarray, rows: Rows, weight: np.ndarray):
        n_terms = len(weight)
        order = halved(rows.sketch(weight), ITEM_LEAF)
        self.terms = np.unique(rows.term)
        column = np.full(n_terms, -1, np.int32)
        column[self.terms] = np.arange(len(self.terms))
        self.number = np.where(order < 0, -1, numbers[order])
        place = np.empty(rows.n, np.int64)
        place[order[order >= 0]] = np.flatnonzero(order >= 0)
        self.weight = greatest(rows, place, len(order), len(self.terms), column)
        self.levels = upward(self.weight.reshape(-1, ITEM_LEAF, len(self.terms)).max(axis=1))


class Search:
    """The k best documents of every item so far, and the walk over trees that finds better ones."""

    def __init__(self, items: Rows, weight: np.ndarray, k: int, floor: np.ndarray):
        self.k, self.weight = k, weight
        # The weakest score that counts: the k-th so far, or the bound from before. Scores above 0 are wanted.
        self.floor = np.maximum(floor, 1)
        self.score = np.zeros((items.n, k), np.int64)
        self.doc = np.full((items.n, k), NO_NUMBER, np.int64)
        self.batches, self.column = [], np.full(len(weight), -1, np.int32)
        size = np.diff(items.edge)
        first = 0
        while first < items.n:
            last = first + 1
            while last < items.n and last - first < ITEMS and items.edge[last + 1] - items.edge[first] <= COLUMNS:
                last += 1
            some = np.arange(first, last)[size[first:last] > 0]
            if len(some):
                self.batches.append(ItemBatch(some, items.take(some), weight))
            first = last
        self.pairs = self.skipped = 0

    def floors(self, batch: ItemBatch) -> list[np.ndarray]:
        """The least floor of every node's items."""
        low = np.where(batch.number < 0, np.iinfo(np.int64).max, self.floor[batch.number])
        levels = [low.reshape(-1, ITEM_LEAF).min(axis=1)]
        while len(levels[0]) > 1:
            levels.insert(0, np.minimum(levels[0][::2], levels[0][1::2]))
        return levels

    def add(self, doc: np.ndarray, rows: Rows) -> None:
        """Looks for better documents in a batch."""
        while rows.n > LEAF and -(-rows.n // LEAF) * 2 * max((len(b.terms) for b in self.batches), default=0) > 1 << 25:
            # Many terms: nodes of half the documents at a time.
            half = rows.n // 2
            self.add(doc[:half], rows.take(np.arange(half)))
            doc, rows = doc[half:], rows.take(np.arange(half, rows.n))
        order = halved(rows.sketch(self.weight), LEAF)
        leaf = np.empty(rows.n, np.int64)
        leaf[order[order >= 0]] = np.flatnonzero(order >= 0) // LEAF
        for batch in self.batches:
            self.column[batch.terms] = np.arange(len(batch.terms))
            self.walk(batch, doc, rows, order, upward(greatest(rows, leaf, len(order) // LEAF, len(batch.terms), self.column)))
            self.column[batch.terms] = -1

    def walk(self, batch: ItemBatch, doc: np.ndarray, rows: Rows, order: np.ndarray, docs: list[np.ndarray]) -> None:
        floors = self.floors(batch)
        depth = max(len(docs), len(batch.levels))
        alive = np.ones((1, 1), bool)
        bound = alive.astype(np.int64)
        for level in range(depth):
            d, i = min(level, len(docs) - 1), min(level, len(batch.levels) - 1)
            if level:
                # Children of live pairs; the shallower tree stays at its leaves.
                alive = np.repeat(alive, 2, axis=0) if d == level else alive
                alive = np.repeat(alive, 2, axis=1) if i == level else alive
            at_d, at_i = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if not len(at_d):
                break
            bound = np.zeros(alive.shape, np.int64)
            bound[np.ix_(at_d, at_i)] = products(docs[d][at_d], batch.levels[i][at_i])
            alive = alive & (bound >= floors[i])
        self.pairs += rows.n * int((batch.number >= 0).sum())
        if not alive.any():
            self.skipped += rows.n * int((batch.number >= 0).sum())
            return
        reach = np.where(alive, bound, 0).max(axis=1)
        for node in np.argsort(-reach, kind="stable").tolist():
            if not reach[node]:
                break
            # Floors have risen since the walk.
            low = np.where(batch.number < 0, np.iinfo(np.int64).max, self.floor[batch.number])
            open_ = np.flatnonzero(alive[node] & (bound[node] >= low.reshape(-1, ITEM_LEAF).min(axis=1)))
            place = (open_[:, None] * ITEM_LEAF + np.arange(ITEM_LEAF)).ravel()
            place = place[batch.number[place] >= 0]
            if not len(place):
                continue
            members = order[node * LEAF: (node + 1) * LEAF]
            members = members[members >= 0]
            inner = rows.take(members)
            score = products(greatest(inner, np.arange(inner.n), inner.n, len(batch.terms), self.column), batch.weight[place])
            self.keep(batch.number[place], doc[members], score)
            self.skipped -= len(members) * len(place)
        self.skipped += rows.n * int((batch.number >= 0).sum())

    def keep(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        """Takes what is better than the k best so far; equal scores go by smaller document number."""
        better = np.flatnonzero((score >= self.floor[item]).any(axis=0))
        if not len(better):
            return
        item, score = item[better], score[:, better]
        fit = score >= self.floor[item]
        total = np.concatenate([self.score[item], np.where(fit, score, 0).T], axis=1)
        docs = np.concatenate([self.doc[item], np.where(fit.T, doc, NO_NUMBER)], axis=1)
        best = np.lexsort((docs, -total), axis=1)[:, : self.k]
        self.score[item], self.doc[item] = np.take_along_axis(total, best, 1), np.take_along_axis(docs, best, 1)
        self.floor[item] = np.maximum(self.floor[item], self.score[item, self.k - 1])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        item, place = np.nonzero(self.score > 0)
        return item, self.doc[item, place], self.score[item, place]


def values(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """A term's value in a document of n terms in which it stands tf times."""
    m = 100 - 90 + (90 * n * documents) // max(length, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """A term's weight by the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def search_group(docs: DataFrame, items: pa.Table, k: int, first: int) -> DataFrame:
    """item (row of the table), doc_id and score of the k best documents of each of some items."""
    spark = docs.sparkSession
    hashes, owner, numbers = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for texts in chunks(items.column("text").combine_chunks()):
        h, o = terms_of(texts)
        hashes.append(h)
        owner.append(o + numbers)
        numbers += texts.n
    hashes, owner = np.concatenate(hashes), np.concatenate(owner)
    known, place = np.unique(hashes, return_inverse=True)
    pair = np.unique(owner * max(len(known), 1) + place)
    owner, place = np.divmod(pair, max(len(known), 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(known)
        for batch in batches:
            for texts in chunks(batch.column(1)):
                h, doc = terms_of(texts)
                at, term = vocabulary.find(h)
                key, tf = np.unique(doc[at] * max(len(known), 1) + term, return_counts=True)
                of, term = np.divmod(key, max(len(known), 1))
                offsets = pa.array(np.searchsorted(of, np.arange(texts.n + 1)), pa.int32())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(texts.first, texts.n), "n": pa.array(np.bincount(doc, minlength=texts.n), pa.int64()),
                    "terms": pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())), "tf": pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))})

    path = scratch(spark, "terms")
    docs.mapInArrow(count, "doc_id long, n long, terms array<int>, tf array<int>").write.parquet(path)
    counted = spark.read.parquet(path)
    documents, length = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(known), np.int64)
    # One row for each term of the group.
    for batch in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow().to_batches():
        df[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    weight = weights(df, documents)
    wanted = (df[place] > 0) & (weight[place] > 0)
    rows = Rows(np.r_[0, np.cumsum(np.bincount(owner[wanted], minlength=numbers))], place[wanted], weight[place][wanted])

    def run(source: DataFrame, floor: np.ndarray) -> DataFrame:
        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = Search(rows, weight, k, floor)
            for batch in batches:
                for begin in range(0, batch.num_rows, BATCH):
                    part = batch.slice(begin, BATCH)
                    lists = part.column(2)
                    edge = lists.offsets.to_numpy().astype(np.int64)
                    cut = 0
                    while cut < part.num_rows:
                        upto = max(cut + 1, int(np.searchsorted(edge, edge[cut] + ENTRIES, side="right")) - 1)
                        some = part.slice(cut, upto - cut)
                        cut = upto
                        inner = some.column(2)
                        at = inner.offsets.to_numpy().astype(np.int64)
                        tf = some.column(3).flatten().to_numpy().astype(np.int64)
                        n = np.repeat(some.column(1).to_numpy(), np.diff(at))
                        doc = some.column(0).fill_null(NO_NUMBER).to_numpy()
                        search.add(doc, Rows(at - at[0], inner.flatten().to_numpy().astype(np.int64), values(tf, n, documents, length)))
            item, doc, score = search.found()
            number = pa.array(doc, pa.int64(), mask=doc == NO_NUMBER)
            yield pa.RecordBatch.from_pydict({"item": pa.array(item, pa.int64()), "doc_id": number, "score": pa.array(score, pa.int64())})

        return source.mapInArrow(walk, "item long, doc_id long, score long")

    found_in = counted.where(F.size("terms") > 0)
    floor = np.zeros(numbers, np.int64)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    if first > 1:
        few = run(found_in.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(first)) == 0), floor)
        # One number for each item of the group.
        kth = few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("item", "score").toArrow()
        floor[kth.column("item").to_numpy()] = kth.column("score").to_numpy()
    return run(found_in, floor).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, *, item: str = "item_id", text: str = "text", group: int = GROUP, first: int = FIRST) -> DataFrame:
    """item, rank (from 1), doc_id and score of the k best documents of every item, as far as scores are above 0.

    Equal scores go by document number.
    """
    spark = docs.sparkSession
    kind = items.schema[item].dataType.simpleString()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = scratch(spark, "items")
    items.select(F.col(item).alias("key"), F.col(text).cast("string").alias("text"), F.monotonically_increasing_id().alias("number")).where(
        "octet_length(text) > 0").write.parquet(path)
    held = spark.read.parquet(path)
    # A text has at most one term for each two bytes.
    size = held.agg(F.coalesce(F.sum(F.octet_length("text") / 2), F.lit(0.0))).first()[0]
    groups = max(1, math.ceil(size / group))
    out = []
    for g in range(groups):
        some = held.where(F.pmod(F.xxhash64("number"), F.lit(groups)) == g).toArrow()
        if some.num_rows:
            keys = spark.createDataFrame(pa.table({"item": pa.array(range(some.num_rows), pa.int64()), "key": some.column("key")}), f"item long, key {kind}")
            found = scratch(spark, "ranked")
            search_group(docs, some, k, first).join(keys, "item").select(
                F.col("key").alias(item), "rank", "doc_id", "score").write.parquet(found)
            out.append(found)
    if not out:
        return spark.createDataFrame([], f"`{item}` {kind}, rank int, doc_id long, score long")
    return spark.read.parquet(*out)
