import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill.llm import lexical

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [x.translate({c: c + 32 for c in range(65, 91)}) for x in TERM.findall(text or "")]


def expected(docs, items, k):
    """docs and items: (number, text). Rows (item, rank, document, score)."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if b[t])
            if s > 0:
                scores.append((-s, math.inf if i is None else i))
        out += [(item, rank, None if i == math.inf else i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def some(rng, n, vocabulary, most):
    out = []
    for i in range(n):
        words = [f"w{int(x) % vocabulary}" for x in rng.zipf(1.3, int(rng.integers(0, most)))]
        out.append((i, rng.choice([" ", ". ", "-", "\n"]).join(words)))
    return out


@pytest.mark.parametrize("seed,k,first", [(1, 10, 64), (2, 3, 2), (3, 1, 1), (4, 500, 4)])
def test_ranks_equal_brute_force(spark, monkeypatch, seed, k, first):
    rng = np.random.default_rng(seed)
    docs, items = some(rng, 300, 400, 60), some(rng, 40, 400, 20)
    docs += [(i + 1000, docs[5][1]) for i in range(20)]  # ties
    monkeypatch.setattr(lexical, "BATCH", 70)
    monkeypatch.setattr(lexical, "ITEMS", 16)
    got = lexical.top_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k, first=first)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs, items, k)


def test_items_in_groups(spark):
    rng = np.random.default_rng(8)
    docs, items = some(rng, 60, 100, 40), some(rng, 12, 100, 10)
    got = lexical.top_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 5, group=60)
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs, items, 5)


def test_odd_rows(spark, docs, odd):
    long = " ".join(f"t{i}" for i in range(3000))
    items = [(1, "one two"), (1, "one two"), (2, None), (3, ""), (4, "!!"), (5, "WÖRT wört Wört x"), (6, "number 5 null"), (7, long), (8, "nowhere")]
    items = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("doc_id", "number", "key", "item", "score")})
    got = lexical.top_documents(odd, items, 10)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, [(r.item_id, r.text) for r in items.collect()], 10)
    assert lexical.top_documents(odd, items.limit(0), 10).collect() == []
    assert lexical.top_documents(odd.limit(0), items, 10).collect() == []


def test_bounds_and_skipping():
    """A node holds its members' greatest values, and whole groups are skipped without a loss."""
    rng = np.random.default_rng(5)
    n, vocabulary = 2000, 600
    size = rng.integers(3, 30, n)
    edge = np.r_[0, np.cumsum(size)]
    side = np.repeat(np.arange(n) % 3, size)  # three languages
    term = side * 200 + np.minimum(rng.zipf(1.4, edge[-1]) % 200, 199)
    key, value = np.unique(np.repeat(np.arange(n), size) * vocabulary + term, return_counts=True)
    docs = lexical.Rows(np.searchsorted(key // vocabulary, np.arange(n + 1)), key % vocabulary, value * 1000)
    weight = rng.integers(1, 9000, vocabulary)
    items = docs.take(np.arange(0, 90))
    items = lexical.Rows(items.edge, items.term, weight[items.term])
    search = lexical.Search(items, weight, 10, np.zeros(items.n, np.int64))
    for first in range(0, n, 500):
        search.add(np.arange(first, first + 500), docs.take(np.arange(first, first + 500)))
    dense, wanted = np.zeros((n, vocabulary)), np.zeros((items.n, vocabulary))
    dense[docs.owner(), docs.term], wanted[items.owner(), items.term] = docs.value, items.value
    score = lexical.products(dense, wanted)
    for i in range(items.n):
        order = np.lexsort((np.arange(n), -score[:, i]))[:10]
        keep = score[order, i] > 0
        assert search.doc[i][: keep.sum()].tolist() == order[keep].tolist()
        assert search.score[i][: keep.sum()].tolist() == score[order, i][keep].tolist()
    assert search.skipped > 0.3 * search.pairs
    [batch] = search.batches
    for above, below in zip(batch.levels, batch.levels[1:], strict=False):
        assert (above == np.maximum(below[::2], below[1::2])).all()
