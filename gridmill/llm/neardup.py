"""Near copies by SetSketch registers: mergeable, locality-sensitive, compared by joint likelihood, confirmed exactly.

A document's set holds its distinct shingles of ``k`` lower-cased words. Register i of a sketch keeps the smallest value of
an exponential variable with rate ``RATE`` over the set, on a scale of powers of ``SCALE`` and truncated at both ends.
Registers of a union are the maxima of registers, so sketches of parts may be merged.

1. One pass over the texts gives the size of each set, two sums that identify the set, and the sketch.
2. Equal sets form one class. All further work is on classes, so a large group of exact copies costs one row.
3. ``BANDS`` bands of ``ROWS`` registers are bucket keys. Of the smallest and largest classes of its buckets every class meets
   three at most. The pairs pass the likelihood test, are confirmed on whole sets, and connected.
4. Nodes that buckets tie together are a family. Where a family still holds several components, they are compared in
   blocks, the largest component not with itself. So a group that hangs together costs as many pairs as it has members.

At a similarity of 0.85 a pair misses all bands with probability (1 - 0.85**4)**24 = 2e-8, at 0.8 with 3e-6. The likelihood test drops a pair only
where 0.85 is less likely than the best estimate by a factor of e**20.

Sets with fewer than 6 shingles can only be linked to equal sets. Null and empty texts have empty sets and are linked with
nothing, as are rows without a document number. Rows that share a document number count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridmill.llm.graphs import components
from gridmill.llm.textarrays import Texts, chunks, mix, shingles, signed, word_hashes
from gridmill.session import scratch

BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
SCALE, RATE, TOP = 1.02, 20.0, 65535
#: Logarithm of the likelihood ratio at which a pair counts as refuted by its sketches.
REFUTED = 20.0
#: Nodes of a block in the comparison across components, and tasks that families of two blocks are dealt over.
BLOCK, SHARED = 1024, 2048

_U = np.uint64
_FACTORS = np.random.Generator(np.random.PCG64(7001)).integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * _U(2) + _U(1)


def sets(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all documents, sorted within each, and the offsets of the documents in them.

    A document of fewer than k words has its whole sequence of words as one shingle.
    """
    words, doc = word_hashes(texts)
    found, at = shingles(words, doc, k)
    owner = doc[at]
    n_words = np.bincount(doc, minlength=texts.n)
    for size in range(1, k):
        few = np.flatnonzero(n_words == size)
        if len(few):
            first = np.searchsorted(doc, few)
            whole = np.full(len(few), size, np.uint64)
            for j in range(size):
                whole = mix(whole + words[first + j] * _U(2 * j + 3))
            found, owner = np.concatenate([found, whole]), np.concatenate([owner, few])
    order = np.argsort(owner, kind="stable")
    found, owner = found[order], owner[order]
    edge = np.searchsorted(owner, np.arange(texts.n + 1))
    kept, offsets = [], np.zeros(texts.n + 1, np.int64)
    for i in range(texts.n):
        own = np.sort(found[edge[i]: edge[i + 1]])
        if len(own) > 1:
            own = own[np.r_[True, own[1:] != own[:-1]]]
        kept.append(own)
        offsets[i + 1] = offsets[i] + len(own)
    return np.concatenate(kept) if kept else found, offsets


def registers(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sketch rows of the sets that begin at ``first`` (none of them empty)."""
    out = np.empty((len(first), REGISTERS), np.uint16)
    for i, factor in enumerate(_FACTORS):
        lowest = np.minimum.reduceat(values * factor, first).astype(np.float64)
        smallest = -np.log1p(-(lowest + 0.5) / 2.0**64 * (1 - 2.0**-53)) / RATE
        out[:, i] = np.clip(np.floor(1 - np.log(smallest) / np.log(SCALE)), 0, TOP)
    return out


def bands(sketch: np.ndarray) -> np.ndarray:
    """Bucket key of every band."""
    key = np.arange(BANDS, dtype=np.uint64)[None, :] + _U(1)
    key = np.repeat(key, len(sketch), axis=0)
    for j in range(ROWS):
        key = mix(key * _U(0x9E3779B97F4A7C15) + sketch[:, j::ROWS].astype(np.uint64))
    return key


def signatures(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (sums that identify the set), sketch and band keys (null for empty sets)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(1)):
                values, offsets = sets(texts, k)
                size = np.diff(offsets)
                some = np.flatnonzero(size)
                f1, f2 = np.zeros(texts.n, np.uint64), np.zeros(texts.n, np.uint64)
                sketch: list = [None] * texts.n
                keys: list = [None] * texts.n
                if len(some):
                    first = offsets[some]
                    f1[some] = np.add.reduceat(mix(values), first)
                    f2[some] = np.add.reduceat(mix(values ^ _U(0x5851F42D4C957F2D)), first)
                    rows = registers(values, first)
                    band = signed(bands(rows))
                    for i, doc in enumerate(some.tolist()):
                        sketch[doc], keys[doc] = rows[i].tobytes(), band[i]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(texts.first, texts.n), "n_shingles": pa.array(size), "f1": signed(f1), "f2": signed(f2),
                    "sketch": pa.array(sketch, pa.binary()), "keys": pa.array(keys, pa.list_(pa.int64()))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sign, "doc_id long, n_shingles long, f1 long, f2 long, sketch binary, keys array<long>")


def plausible(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of sketches leave a similarity of ``least`` likely enough, by the joint likelihood of their registers."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u, v = na / (na + nb), nb / (na + nb)
    most = np.minimum(u / v, v / u)

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        p = lambda x: -np.log(np.maximum(1 - np.clip(x, 0, 1) * (SCALE - 1) / SCALE, 1e-300)) / np.log(SCALE)
        up, down = p(u - v * j), p(v - u * j)
        return above * np.log(np.maximum(up, 1e-12)) + below * np.log(np.maximum(down, 1e-12)) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    grid = np.stack([log_likelihood(np.minimum(j, most)) for j in np.linspace(0, 1, 101)])
    enough = np.max(np.stack([log_likelihood(np.minimum(j, most)) for j in np.linspace(least, 1, 31)]), axis=0)
    return (most >= least - 1e-9) & (grid.max(axis=0) - enough <= REFUTED)


def _linked(pairs: DataFrame, sketches: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that pass the likelihood test and then the exact one."""

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("sketch_a", "sketch_b")]
                sizes = [batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
                ok = plausible(*rows, *sizes, percent / 100)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda df, s: df.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in df.columns if c != "node"])
    judged = pairs.join(side(sketches, "a"), "a").join(side(sketches, "b"), "b").mapInArrow(likely, "a long, b long")
    return judged.join(side(whole, "a"), "a").join(side(whole, "b"), "b").mapInArrow(confirm, "a long, b long")


def _across(ties: DataFrame, labels: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """Pairs of components that a link joins, within families: components that buckets tie together, directly or not.

    The largest component of a family is not compared with itself. All others are cut into blocks, as it is, and a task gets
    two blocks. A node so travels once for each block it meets, not for each node, and only links leave the task, one for
    each two components.
    """
    family = components(_renamed(ties, labels)).select(F.col("node").alias("label"), F.col("label").alias("family"))
    # A component without any link is a node of its own.
    every = labels.unionByName(family.select(F.col("label").alias("node"), "label")).distinct()
    named = every.join(family, "label")
    sizes = named.groupBy("family", "label").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("family").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n")).where("top.n < n").select(
        "family", F.col("top.label").alias("main"), F.ceil(F.col("top.n") / BLOCK).alias("n_main"), F.ceil((F.col("n") - F.col("top.n")) / BLOCK).alias("n_rest"))
    # Blocks 0 .. n_rest - 1 hold the small components, the others the largest one.
    dealt = named.join(largest, "family").withColumn("block", F.when(
        F.col("label") == F.col("main"), F.col("n_rest") + F.pmod(F.xxhash64("node"), "n_main")).otherwise(F.pmod(F.xxhash64("node"), "n_rest")))
    rest = F.col("block") < F.col("n_rest")
    other = F.explode(F.when(rest, F.expr("sequence(0L, n_rest + n_main - 1)")).otherwise(F.expr("sequence(0L, n_rest - 1)")))
    met = dealt.select("node", "label", "family", "block", "n_main", "n_rest", other.alias("other")).select(
        "node", "label", "family", (F.col("block") <= F.col("other")).alias("first"), (F.col("block") >= F.col("other")).alias("second"),
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("n_main") + F.col("n_rest")).alias("blocks"))
    # Families of one block of each kind share tasks.
    group = F.when(F.col("blocks") > 2, F.xxhash64("family", "i", "j")).otherwise(F.pmod(F.xxhash64("family"), F.lit(SHARED)))

    def compare(table: pa.Table) -> pa.Table:
        found: set[tuple[int, int]] = set()
        keys = list(zip(*(table.column(c).to_pylist() for c in ("family", "i", "j")), strict=True))
        label = table.column("label").to_pylist()
        first, second = (table.column(c).to_numpy() for c in ("first", "second"))
        sets_ = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("set")]
        places: dict[tuple, list[int]] = {}
        for at, key in enumerate(keys):
            places.setdefault(key, []).append(at)
        for own in places.values():
            left, right = [x for x in own if first[x]], [x for x in own if second[x]]
            for x, y in _pairs([sets_[k] for k in left], [sets_[k] for k in right], percent):
                p, q = left[x], right[y]
                if label[p] != label[q]:
                    found.add((min(label[p], label[q]), max(label[p], label[q])))
        pairs = sorted(found)
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    return met.join(whole, "node").withColumn("_group", group).groupBy("_group").applyInArrow(compare, "a long, b long")


def _pairs(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Places of all similar sets of two lists, from the product of their incidence matrices over common elements."""
    if not left or not right:
        return []
    a, b = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(a, b)
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    shared = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, len(common), 1 << 13):
        part = common[begin: begin + (1 << 13)]
        marks = []
        for flat, size in ((a, sizes[0]), (b, sizes[1])):
            at = np.minimum(np.searchsorted(part, flat), len(part) - 1)
            on = np.flatnonzero(part[at] == flat)
            matrix = np.zeros((len(size), len(part)), np.float32)
            matrix[np.repeat(np.arange(len(size)), size)[on], at[on]] = 1
            marks.append(matrix)
        shared += marks[0] @ marks[1].T
    shared = shared.astype(np.int64)
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    return list(zip(*(x.tolist() for x in np.nonzero((shared > 0) & (100 * shared >= percent * union))), strict=True))


def near_copies(docs: DataFrame, *, k: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; links are 100 * intersection >= percent * union."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows = stored(signatures(docs, k), "signatures")
    usable = rows.where("n_shingles > 0 and doc_id is not null")
    identity = ["n_shingles", "f1", "f2"]
    classes = usable.groupBy(*identity).agg(F.min("doc_id").alias("node"))
    # Without repeated numbers a document stands in one class only; the links below join what repeated numbers share.
    same = usable.select("doc_id", *identity).join(classes, identity).where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct()
    # The row that stands for its class. Sets below the least size that another set can be similar to need no bucket.
    small = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    chosen = usable.where(F.col("n_shingles") >= small).join(classes.withColumnRenamed("node", "doc_id"), [*identity, "doc_id"], "left_semi").dropDuplicates(["doc_id", "f1"])
    keyed = chosen.select(F.col("doc_id").alias("node"), F.explode("keys").alias("key")).distinct()
    ends = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    buckets = stored(keyed.join(ends, "key"), "buckets")
    members = buckets.select("node").distinct()
    sketches = stored(chosen.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "sketch").join(members, "node", "left_semi"), "sketches")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(1)):
                values, offsets = sets(texts, k)
                blobs = [values[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
                yield pa.RecordBatch.from_pydict({"node": batch.column(0).slice(texts.first, texts.n), "set": pa.array(blobs, pa.binary())})

    whole = stored(docs.join(members, docs["doc_id"] == members["node"], "left_semi").mapInArrow(collect, "node long, set binary"), "sets")

    # Of the ends of its buckets a class meets the first, the last, and the one with which it shares most buckets.
    met = buckets.select("node", F.explode(F.array("low", "high")).alias("end")).where("node <> end").groupBy("node", "end").agg(F.count("*").alias("n"))
    chosen_ends = met.groupBy("node").agg(F.array_distinct(F.array(F.min("end"), F.max("end"), F.max(F.struct("n", "end"))["end"])).alias("ends"))
    tried = chosen_ends.select("node", F.explode("ends").alias("end")).select(F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b")).distinct()
    links = stored(_linked(tried, sketches, whole, percent), "links")
    ties = buckets.select(F.col("low").alias("a"), F.col("node").alias("b")).where("a < b").distinct()
    # From here on a component stands for its nodes.
    labels = components(links)
    more = stored(_across(ties, labels, whole, percent).unionByName(_renamed(same, labels)), "more")
    final = labels
    if not more.isEmpty():
        joined = components(more).select(F.col("node").alias("label"), F.col("label").alias("root"))
        both = labels.unionByName(joined.select(F.col("label").alias("node"), "label")).distinct()
        final = both.join(joined, "label", "left").select("node", F.coalesce("root", "label").alias("label")).groupBy("node").agg(F.min("label").alias("label"))
    return rows.select("doc_id", "n_shingles").join(final, rows["doc_id"] == final["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("label", "doc_id"), F.lit(True)).alias("kept"))


def _renamed(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes as pairs of their components, those of two components only."""
    name = lambda s: labels.select(F.col("node").alias(s), F.col("label").alias(f"{s}_label"))
    named = pairs.join(name("a"), "a", "left").join(name("b"), "b", "left")
    return named.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")).where("a <> b").distinct()
