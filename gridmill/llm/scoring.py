"""Log-bilinear language model, trained by noise-contrastive estimation in numpy, with normalised token log-probabilities.

Tokens are lower-cased words and one end per document. Every token has one of ``CLASSES`` classes: the most frequent
tokens have a class each, all others share classes by their last two bytes, so that a word no one has seen has one too.
p(token | two tokens before) = p(class | two classes before) * p(token in class). The first factor is the log-bilinear
model; the second is (c + 1) / (N_class + V_class + 1), which leaves room for unseen words as the base score does.

1. Words are counted over all learning rows; counts of hashed words are summed by Spark.
2. Class trigrams are counted over all learning rows: at most CLASSES**3 rows, whatever the corpus.
3. Each round, tasks train copies of the model on their contexts by noise-contrastive estimation (the expected loss
   over the noise distribution, so no draw is random); the driver averages the copies, a few thousand numbers each.
4. Scoring multiplies all context vectors with all class vectors in batches and normalises over the classes. Counts of the
   ``FREQUENT`` most frequent words are at hand in every task; other words are joined to the table of counts.

Null and empty texts are the end token alone. Rows without a document number learn, and are scored, like others. Rows that
repeat a document are scored each. With nothing to learn from, every token is unseen. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridmill.llm.language import held_out
from gridmill.llm.textarrays import LOWER, Texts, chunks, mix, prefix_sums, signed, span_hash
from gridmill.session import scratch

#: Classes, those of one token each, and words whose counts every task holds (16 bytes each).
CLASSES, SINGLE, FREQUENT = 256, 128, 262_144
DIM, NOISE, EPOCHS, ROUNDS, RATE, PARTS = 32, 8, 4, 3, 0.1, 8
END = np.uint64(0xE4D0E4D0E4D0E4D0)
#: Counted rows that a task holds before it hands them on.
HELD = 1 << 20


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, tail class and document of all tokens in order, the end of each document included."""
    start, end, doc = texts.words()
    data = LOWER[texts.data]
    words = span_hash(prefix_sums(data), start, end)
    last = data[end - 1].astype(np.uint64)
    before = np.where(end - start > 1, data[np.maximum(end - 2, 0)], 0).astype(np.uint64)
    tail = (mix(last << np.uint64(8) | before) >> np.uint64(40)).astype(np.int64) % (CLASSES - SINGLE)
    place = np.arange(len(words)) + doc
    n = len(words) + texts.n
    out, kind, owner = np.full(n, END), np.zeros(n, np.int64), np.empty(n, np.int64)
    out[place], kind[place], owner[place] = words, tail, doc
    owner[np.cumsum(np.bincount(doc, minlength=texts.n) + 1) - 1] = np.arange(texts.n)
    return out, kind, owner


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _counted(keys_of, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sums of the keys of all texts, handed on whenever too many are held."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for texts in chunks(batch.column(0)):
            held.append(np.unique(keys_of(texts), return_counts=True))
            if sum(len(k) for k, _ in held) > HELD:
                held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
                if len(held[0][0]) > HELD // 2:
                    yield held.pop()
    if held:
        yield _summed(*map(np.concatenate, zip(*held, strict=True)))


def word_counts(rows: DataFrame) -> DataFrame:
    """word (its key), n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, n in _counted(lambda texts: keyed(texts)[0], batches):
            yield pa.RecordBatch.from_pydict({"word": signed(key), "n": n.astype(np.int64)})

    return rows.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def keyed(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key (hash with its tail class in the lowest bits), tail class and document of all tokens."""
    word, tail, doc = tokens(texts)
    return (word & ~np.uint64(CLASSES - SINGLE - 1)) | tail.astype(np.uint64), tail, doc


class Vocabulary:
    """The most frequent keys, sorted, with their counts; the first ``SINGLE`` by count have a class of their own."""

    def __init__(self, key: np.ndarray, n: np.ndarray):
        rank = np.lexsort((key, -n))
        self.single = np.sort(key[rank[:SINGLE]])
        order = np.argsort(key)
        self.key, self.n = key[order], n[order]

    def classes(self, key: np.ndarray, tail: np.ndarray) -> np.ndarray:
        out = SINGLE + tail
        if len(self.single):
            at = np.minimum(np.searchsorted(self.single, key), len(self.single) - 1)
            own = self.single[at] == key
            out[own] = at[own]
        return out

    def end_class(self) -> int:
        return int(self.classes(np.array([END & ~np.uint64(CLASSES - SINGLE - 1)]), np.zeros(1, np.int64))[0])


def contexts(kind: np.ndarray, doc: np.ndarray, end: int) -> np.ndarray:
    """Number of the pair of classes before each token; before a document stand ends."""
    one, two = np.full(len(kind), end), np.full(len(kind), end)
    one[1:] = np.where(doc[1:] == doc[:-1], kind[:-1], end)
    two[2:] = np.where(doc[2:] == doc[:-2], kind[:-2], end)
    return two * CLASSES + one


class Model:
    """Class vectors: ``before`` for contexts scaled by ``place`` for each distance, ``after`` and ``bias`` for targets."""

    def __init__(self, noise: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.before = rng.normal(0, 0.1, (CLASSES, DIM)).astype(np.float32)
        self.after = rng.normal(0, 0.1, (CLASSES, DIM)).astype(np.float32)
        self.place = np.ones((2, DIM), np.float32)
        self.noise = noise.astype(np.float32)
        self.bias = np.log(self.noise)

    def parts(self) -> list[np.ndarray]:
        return [self.before, self.after, self.place, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def load(self, flat: np.ndarray) -> Model:
        at = 0
        for p in self.parts():
            p[...] = flat[at: at + p.size].reshape(p.shape)
            at += p.size
        return self

    def train(self, context: np.ndarray, target: np.ndarray, n: np.ndarray, epochs: int, rng) -> None:
        """Noise-contrastive estimation over counted (context, target) pairs, contexts in batches, AdaGrad steps."""
        every, row = np.unique(context, return_inverse=True)
        order = np.argsort(row, kind="stable")
        row, target, n = row[order], target[order], n[order].astype(np.float32)
        first = np.searchsorted(row, np.arange(len(every) + 1))
        log_noise = np.log(NOISE * self.noise)
        squares = [np.full(p.shape, 1e-6, np.float32) for p in self.parts()]
        for _ in range(epochs):
            shuffled = rng.permutation(len(every))
            for begin in range(0, len(every), 1024):
                pick = np.sort(shuffled[begin: begin + 1024])
                size = first[pick + 1] - first[pick]
                at = np.repeat(first[pick] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
                seen = np.zeros((len(pick), CLASSES), np.float32)
                seen[np.repeat(np.arange(len(pick)), size), target[at]] = n[at]
                two, one = every[pick] // CLASSES, every[pick] % CLASSES
                hidden = self.before[two] * self.place[0] + self.before[one] * self.place[1]
                data = 1 / (1 + np.exp(-np.clip(hidden @ self.after.T + self.bias - log_noise, -30, 30)))
                total = seen.sum(axis=1, keepdims=True)
                slope = seen * (1 - data) - NOISE * total * self.noise * data
                # Frequent contexts count by the root of their frequency within a batch: all are met equally often.
                slope /= np.sqrt(total) * np.sqrt(total).mean()
                back = slope @ self.after
                before = np.zeros_like(self.before)
                np.add.at(before, two, back * self.place[0])
                np.add.at(before, one, back * self.place[1])
                place = np.stack([(back * self.before[two]).sum(axis=0), (back * self.before[one]).sum(axis=0)])
                for p, sq, g in zip(self.parts(), squares, [before, slope.T @ hidden, place, slope.sum(axis=0)], strict=True):
                    g = g / len(pick)
                    sq += g * g
                    p += RATE * g / np.sqrt(sq)

    def table(self) -> np.ndarray:
        """log10 p(class | context) for all contexts, from matrix products of 4096 contexts at a time."""
        out = np.empty((CLASSES * CLASSES, CLASSES), np.float32)
        for begin in range(0, len(out), 4096):
            c = np.arange(begin, begin + 4096)
            hidden = self.before[c // CLASSES] * self.place[0] + self.before[c % CLASSES] * self.place[1]
            score = hidden @ self.after.T + self.bias
            score -= score.max(axis=1, keepdims=True)
            score -= np.log(np.exp(score).sum(axis=1, keepdims=True))
            out[begin: begin + 4096] = score / np.float32(np.log(10))
        return out


def class_trigrams(rows: DataFrame, vocabulary) -> DataFrame:
    """code ((two before, one before, class) as one number), n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        end = known.end_class()

        def codes(texts: Texts) -> np.ndarray:
            key, tail, doc = keyed(texts)
            kind = known.classes(key, tail)
            return contexts(kind, doc, end) * CLASSES + kind

        for code, n in _counted(codes, batches):
            yield pa.RecordBatch.from_pydict({"code": code.astype(np.int32), "n": n.astype(np.int64)})

    return rows.mapInArrow(count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def fit(trigrams: DataFrame) -> Model:
    """Rounds of local training and averaging; ``trigrams`` is read anew in each."""
    spark = trigrams.sparkSession
    kinds = trigrams.groupBy((F.col("code") % CLASSES).alias("kind")).agg(F.sum("n").alias("n")).toArrow()
    noise = np.full(CLASSES, 1.0)
    noise[kinds.column("kind").to_numpy()] += kinds.column("n").to_numpy()
    model = Model(noise / noise.sum())
    for turn in range(ROUNDS):
        start = spark.sparkContext.broadcast(model)

        def train(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            found = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
            if sum(len(c) for c, _ in found):
                code, n = map(np.concatenate, zip(*found, strict=True))
                order = np.argsort(code)
                own = Model(start.value.noise).load(start.value.flat())
                own.train(code[order] // CLASSES, code[order] % CLASSES, n[order], EPOCHS, np.random.default_rng(turn))
                yield pa.RecordBatch.from_pydict({"weights": pa.array([own.flat().tobytes()]), "n": [int(n.sum())]})

        # At most CLASSES**2 contexts exist, so PARTS tasks are enough for any corpus, and PARTS rows come back.
        parted = trigrams.repartition(PARTS, F.expr(f"code div {CLASSES}"))
        copies = parted.mapInArrow(train, "weights binary, n long").toArrow()
        if len(copies):
            weight = copies.column("n").to_numpy().astype(np.float64)
            flat = np.stack([np.frombuffer(x, np.float32) for x in copies.column("weights").to_pylist()])
            order = np.lexsort(flat[:, :4].T)
            model.load((flat[order] * (weight[order] / weight.sum())[:, None]).sum(axis=0).astype(np.float32))
    return model


def score(docs: DataFrame, learns: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score for every row, learning from rows where ``learns`` holds."""
    spark = docs.sparkSession
    learning = docs.where(learns).select("text")
    path = scratch(spark, "word-counts")
    word_counts(learning).write.parquet(path)
    counts = spark.read.parquet(path)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    vocabulary = Vocabulary(top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy())
    del top
    # Tokens and distinct words of every class.
    tails = counts.groupBy((F.col("word").bitwiseAND(CLASSES - SINGLE - 1)).alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).toArrow()
    size, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    size[SINGLE + tails.column("tail").to_numpy()] = tails.column("n").to_numpy()
    kinds[SINGLE + tails.column("tail").to_numpy()] = tails.column("v").to_numpy()
    for j, key in enumerate(vocabulary.single):
        n, tail = vocabulary.n[np.searchsorted(vocabulary.key, key)], SINGLE + int(key & np.uint64(CLASSES - SINGLE - 1))
        size[j], kinds[j] = n, 1
        size[tail] -= n
        kinds[tail] -= 1
    room = np.log10(size + kinds + 1)
    held = spark.sparkContext.broadcast(vocabulary)
    path = scratch(spark, "class-trigrams")
    class_trigrams(learning, held).write.parquet(path)
    model = spark.sparkContext.broadcast((fit(spark.read.parquet(path)), room))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        net, own_room = model.value
        table, end = net.table().ravel(), known.end_class()
        for batch in batches:
            for texts in chunks(batch.column("text")):
                key, tail, doc = keyed(texts)
                kind = known.classes(key, tail)
                value = table[contexts(kind, doc, end) * CLASSES + kind] - own_room[kind]
                at = np.minimum(np.searchsorted(known.key, key), max(0, len(known.key) - 1))
                here = known.key[at] == key if len(known.key) else np.zeros(len(key), bool)
                logs = np.where(here, np.log10(known.n[at] + 1.0), 0.0) if len(known.key) else np.zeros(len(key))
                away = np.flatnonzero(~here)
                ids = batch.column("doc_id").slice(texts.first, texts.n)
                rows = batch.column("row").slice(texts.first, texts.n)
                by = lambda w=None: np.bincount(doc, w, minlength=texts.n)
                yield pa.RecordBatch.from_pydict({
                    "row": rows, "doc_id": ids, "n_tokens": by(), "n_known": by(here).astype(np.int64), "logs": by(logs),
                    "model": by(value), "word": rows, "rare": np.zeros(texts.n, np.int64)})
                for begin in range(0, len(away), 1 << 18):
                    part = away[begin: begin + (1 << 18)]
                    n = len(part)
                    yield pa.RecordBatch.from_pydict({
                        "row": rows.take(pa.array(doc[part])), "doc_id": ids.take(pa.array(doc[part])), "n_tokens": pa.nulls(n, pa.int64()),
                        "n_known": pa.nulls(n, pa.int64()), "logs": pa.nulls(n, pa.float64()), "model": pa.nulls(n, pa.float64()),
                        "word": signed(key[part]), "rare": np.ones(n, np.int64)})

    seen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("doc_id", "text").alias("row")).mapInArrow(
        look, "row long, doc_id long, n_tokens long, n_known long, logs double, model double, word long, rare long")
    # Rows of documents carry their own hash as the word: they spread evenly and are no words.
    joined = seen.join(counts.select("word", "n"), "word", "left").withColumn("n", F.when(F.col("rare") == 1, F.coalesce("n", F.lit(0))))
    # Equal rows are one group here and as many rows again below.
    grouped = joined.groupBy("row", "doc_id").agg(
        F.sum(1 - F.col("rare")).alias("times"), F.max("n_tokens").alias("n_tokens"), F.max("n_known").alias("near"), F.max("logs").alias("logs"),
        F.max("model").alias("model"), F.sum((F.col("n") > 0).cast("long")).alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("rare_logs"))
    logs = F.col("logs") + F.coalesce(F.col("rare_logs") / F.col("times"), F.lit(0.0))
    return grouped.withColumn("_again", F.explode(F.expr("sequence(1, int(times))"))).select(
        "doc_id", "n_tokens", (F.col("near") + F.coalesce((F.col("more") / F.col("times")).cast("long"), F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(total + distinct + 1.0))).alias("base_score"), (F.col("model") + logs).alias("score"))


def scored(docs: DataFrame, parts: int = 7) -> DataFrame:
    """``score`` with the rows that are not held out as learning rows; adds held_out."""
    return score(docs, ~held_out(parts)).withColumn("held_out", held_out(parts))
