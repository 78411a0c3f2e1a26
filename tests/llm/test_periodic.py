import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gridmill.llm import periodic, queries
from gridmill.llm.textarrays import chunks, word_hashes


def brute(w, least=6, times=4):
    """Every maximal stretch of every period, compared word by word."""
    out = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q):
                part = w[i: i + size]
                if q == next(p for p in range(1, size + 1) if part[p:] == part[: size - p]):
                    out.add((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def left(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def made(rng):
    n, letters = rng.choice([0, 1, 5, 6, 7, 20, 60, 150, 400]), "abcdefgh"[: rng.choice([1, 2, 2, 3, 5])]
    w = [rng.choice(letters) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 3))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.4:
            w[rng.randrange(n)] = "z"
    return w


@pytest.mark.parametrize("times", [2, 3, 4])
def test_runs_of_small_alphabets(times):
    rng = random.Random(times)
    for _ in range(60):
        words = [made(rng) for _ in range(rng.randint(1, 8))]
        texts = next(iter(chunks(pa.array([rng.choice(["", " \n"]) + rng.choice([" ", "\n", "\t "]).join(w) for w in words]))))
        hashes, owner = word_hashes(texts, lower=False)
        size = np.bincount(owner, minlength=texts.n)
        doc, start, length, period = periodic.find_runs(hashes, size, 6, times)
        kept = periodic.collapsed(texts, size, doc, start, length, period).to_pylist()
        for i, w in enumerate(words):
            expected = brute(w, 6, times)
            assert list(zip(start[doc == i].tolist(), length[doc == i].tolist(), period[doc == i].tolist(), strict=True)) == expected
            assert kept[i] == left(w, expected)


def test_places_in_pieces(monkeypatch):
    rng = random.Random(9)
    words = [made(rng) for _ in range(6)]
    flat = np.array([ord(x) for w in words for x in w], np.uint64)
    size = np.array([len(w) for w in words])
    whole = periodic.find_runs(flat, size)
    monkeypatch.setattr(periodic, "PLACES", 7)
    for a, b in zip(whole, periodic.find_runs(flat, size), strict=True):
        assert a.tolist() == b.tolist()


def test_cover_meets_everywhere():
    assert {(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER} == set(range(periodic.MODULUS))


def test_one_word_a_million_times():
    found = periodic.find_runs(np.full(1_000_000, 7, np.uint64), np.array([1_000_000]))
    assert [x.tolist() for x in found] == [[0], [0], [1_000_000], [1]]


def test_query_equals_brute_force(spark, tables):
    got = {r.doc_id: r for r in queries.op13(spark, "/root/testdata/sf0.001").collect()}
    rows = tables.documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    with_runs = 0
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        n, h = len(w), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute(w)
        with_runs += bool(runs)
        top = max(runs, key=lambda x: (x[1], -x[0], -x[2])) if runs else None
        x = got[r.doc_id]
        assert (x.n_runs, x.start, x.length, x.period) == (len(runs), *(top or (None,) * 3))
        assert x.exponent_milli == (1000 * top[1] // top[2] if top else None)
        assert x.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert x.collapsed_sha256 == hashlib.sha256(left(w, runs).encode()).hexdigest()
    assert with_runs > 5


def test_odd_rows(spark, odd, docs):
    rows = periodic.periodic_runs(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.n_words, len(r.runs), r.collapsed) for r in rows if r.doc_id in (0, 1, 2)} == {(0, 0, "")}
    assert all(r.collapsed is not None for r in rows)
    assert periodic.periodic_runs(odd.limit(0)).collect() == []
    [six] = periodic.periodic_runs(docs("no no no  no\nno no")).collect()
    assert [tuple(x) for x in six.runs] == [(0, 6, 1)] and six.collapsed == "no"
    with pytest.raises(ValueError):
        periodic.periodic_runs(odd, times=1)
