"""Language of documents by mixture inference over n-gram likelihoods.

Training counts byte trigrams of words by language over all learning rows; Spark sums them. A word's likelihood under a
language is the product over its trigrams. A document is a mixture of languages, its proportions found by
expectation-maximisation over its words. The set of languages is chosen by penalised likelihood: one more language is
let in only if it raises the log-likelihood by more than ``penalty`` times the logarithm of the number of words.

The model is one row of ``BUCKETS`` numbers per language, at most ``MAX_LANGUAGES`` languages, whatever the input.

A null text, or one without a letter, is ``und`` with score 0 and no proportions. Rows with a null language, or without a
letter, teach nothing. With nothing to learn from, every text is ``und``. Repeated rows count as often as they occur. Ties go to the language that
comes first in the alphabet. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from gridmill.llm.textarrays import Texts, chunks

BUCKETS = 1 << 14
MAX_LANGUAGES = 1024
PENALTY = 1.5
ROUNDS = 8
UNKNOWN = "und"
#: Evidence (nats a trigram over trigrams that are all alike likely) below which no learnt language explains a text.
NO_LANGUAGE = -0.9
#: Trigrams without evidence for or against that every text has besides its own: a short one tells little.
PRIOR = 48

#: Letters as they are or lower-cased, all else of ASCII as a gap between words.
SYMBOL = np.zeros(256, np.uint8)
SYMBOL[ord("a"): ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
SYMBOL[ord("A"): ord("Z") + 1] = SYMBOL[ord("a"): ord("z") + 1]
SYMBOL[0x80:] = np.arange(0x80, 0x100)


def grams(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the trigram around each byte of a word, the first trigram of each word, and the word's document."""
    symbol = np.zeros(len(texts.data) + 2, np.uint8)
    symbol[1:-1] = SYMBOL[texts.data]
    inside = symbol != 0
    at = np.flatnonzero(inside)
    code = symbol[at - 1].astype(np.uint32) << 16 | symbol[at].astype(np.uint32) << 8 | symbol[at + 1]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)
    first = np.flatnonzero(~inside[at - 1])
    return bucket, first, texts.documents_of(at[first] - 1)


def learn(docs: DataFrame, learns: Column) -> tuple[list[str], np.ndarray]:
    """Languages in alphabetical order and log-probabilities [bucket, language], from the rows where ``learns`` holds."""
    rows = docs.where(learns & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(F.col("lang").cast("string"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            names, lang = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for texts in chunks(batch.column(1)):
                bucket, first, doc = grams(texts)
                own = np.repeat(lang[texts.first: texts.first + texts.n][doc], np.diff(np.r_[first, len(bucket)]))
                seen = np.bincount(own * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for k in np.unique(own).tolist():
                    total[names[k]] = total.get(names[k], 0) + seen[k]
        for name, row in total.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_pydict({"lang": [name] * len(at), "bucket": pa.array(at, pa.int32()), "n": row[at]})

    counted = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    known = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if known > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    table = counted.toArrow()
    languages = sorted(set(table.column("lang").to_pylist()))
    seen = np.zeros((BUCKETS, len(languages)))
    if languages:
        order = {name: k for k, name in enumerate(languages)}
        seen[table.column("bucket").to_numpy(), [order[x] for x in table.column("lang").to_pylist()]] = table.column("n").to_numpy()
    seen += 0.5
    return languages, np.log(seen / seen.sum(axis=0)).astype(np.float32)


def _mixture(like: np.ndarray, first: np.ndarray, size: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages for each document, and the log of the summed word likelihood."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    ones = np.ones(like.shape[1])
    for _ in range(rounds):
        joint = like * np.repeat(share, size, axis=0)
        joint /= np.maximum(joint @ ones, 1e-300)[:, None]
        share = np.add.reduceat(joint, first, axis=0) / size[:, None]
    total = (like * np.repeat(share, size, axis=0)) @ ones
    return share, np.add.reduceat(np.log(np.maximum(total, 1e-300)), first)


def infer(texts: Texts, logp: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents with words, their proportions over all languages, the certainty of the leading one, and the evidence.

    Evidence is the mean log-likelihood of a trigram in the chosen languages beyond that of trigrams that are all alike likely,
    drawn towards 0 for short texts.
    """
    bucket, first, doc = grams(texts)
    n = logp.shape[1]
    if not len(bucket) or not n:
        return np.zeros(0, np.int64), np.zeros((0, n)), np.zeros(0), np.zeros(0)
    word = np.add.reduceat(logp[bucket], first, axis=0).astype(np.float64)
    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    size = np.diff(np.r_[begin, len(doc)])
    alone = np.add.reduceat(word, begin, axis=0)
    best = alone.argmax(axis=1)
    top = alone.max(axis=1)
    certain = 1 / np.exp(np.maximum(alone - top[:, None], -700)).sum(axis=1)
    share = np.zeros_like(alone)
    share[np.arange(len(best)), best] = 1
    peak = word.max(axis=1, keepdims=True)
    price = penalty * np.log(size + 1.0) + 2
    # The best language of every word on its own bounds what any mixture can reach.
    bound = np.add.reduceat(peak[:, 0], begin)
    open_docs = np.flatnonzero((n > 1) & (bound - price > top))
    score = top
    while len(open_docs):
        pick = np.repeat(np.isin(np.arange(len(size)), open_docs), size)
        like = np.exp(word[pick] - peak[pick])
        own = size[open_docs]
        at = np.r_[0, np.cumsum(own)[:-1]]
        lift = bound[open_docs]
        have = share[open_docs] > 0
        gain, chosen = np.full(len(open_docs), -np.inf), np.zeros((len(open_docs), n))
        for k in range(n):
            tried = have.copy()
            tried[:, k] = True
            mixed, total = _mixture(like, at, own, tried.astype(float), rounds)
            now = np.where(have[:, k], -np.inf, total + lift - price[open_docs] * (tried.sum(axis=1) - 1))
            better = now > gain
            gain[better], chosen[better] = now[better], mixed[better]
        wins = gain > score[open_docs] + 1e-9
        won = open_docs[wins]
        share[won], score[won] = chosen[wins], gain[wins]
        certain[won] = 1
        open_docs = won[(share[won] > 0).sum(axis=1) < n]
    trigrams = np.add.reduceat(np.diff(np.r_[first, len(bucket)]), begin)
    return doc[begin], share, certain, (np.maximum(top, score) + trigrams * np.log(BUCKETS)) / (trigrams + PRIOR)


def predict(docs: DataFrame, languages: list[str], logp: np.ndarray, *, penalty: float = PENALTY, keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` with lang_pred, score, langs and proportions (the chosen languages, largest first), and evidence.

    Evidence is null without a letter; below ``NO_LANGUAGE`` the text is none of the languages, whichever is nearest.

    A text is only read, not returned, unless ``keep_text`` is set.
    Columns named like a new one are replaced."""
    docs = docs.drop("lang_pred", "score", "langs", "proportions", "evidence", "_lettered")
    columns = [c for c in docs.columns if keep_text or c != "text"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in columns)
    model = docs.sparkSession.sparkContext.broadcast((languages, logp))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = model.value
        for batch in batches:
            for texts in chunks(batch.column("text")):
                lettered = pc.fill_null(batch.column("_lettered").slice(texts.first, texts.n), False).to_numpy(zero_copy_only=False)
                pred, score = [UNKNOWN] * texts.n, np.zeros(texts.n)
                langs, parts, evidence = [[] for _ in range(texts.n)], [[] for _ in range(texts.n)], [None] * texts.n
                found, share, certain, likely = infer(texts, table, penalty)
                order = np.argsort(-share, axis=1, kind="stable")
                for i, doc in enumerate(found.tolist()):
                    if lettered[doc]:
                        chosen = [k for k in order[i].tolist() if share[i, k] > 0]
                        pred[doc], score[doc] = names[chosen[0]], min(1.0, share[i, chosen[0]] * certain[i])
                        langs[doc], parts[doc], evidence[doc] = [names[k] for k in chosen], share[i, chosen].tolist(), float(likely[i])
                kept = [batch.column(c).slice(texts.first, texts.n) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(pred, pa.string()), pa.array(score), pa.array(langs, pa.list_(pa.string())), pa.array(parts, pa.list_(pa.float64())),
                     pa.array(evidence, pa.float64())],
                    names=[*columns, "lang_pred", "score", "langs", "proportions", "evidence"])

    return docs.withColumn("_lettered", F.col("text").rlike(r"\p{L}")).mapInArrow(
        label, f"{kinds}, lang_pred string, score double, langs array<string>, proportions array<double>, evidence double")


def held_out(parts: int) -> Column:
    """Rows kept out of learning: the checksum of the document number, modulo ``parts``, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == 2, F.lit(False))


def identify(docs: DataFrame, parts: int = 4) -> DataFrame:
    """Learns from the rows that are not held out and predicts all: doc_id, held_out, lang_pred, score, langs, proportions, evidence."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    languages, logp = learn(docs, ~held_out(parts))
    return predict(docs.select("doc_id", "text"), languages, logp).select("doc_id", held_out(parts).alias("held_out"), "lang_pred", "score", "langs", "proportions", "evidence")
