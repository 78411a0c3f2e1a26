"""Language, packing, scoring and quality: against brute force, by round trip, on held-out rows, and on odd rows."""

import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gridmill.llm import language, packing, quality, scoring
from gridmill.llm.textarrays import chunks, word_hashes

from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(doc_id, parts):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == 2


def test_words_of_chunks_are_words_of_texts():
    texts = ["a b", None, "", " x\ty\nz ", "é à", "end"]
    for limit in (1, 4, 1 << 20):
        seen = defaultdict(list)
        for t in chunks(pa.array(texts), limit):
            start, end, doc = t.words()
            for a, b, d in zip(start, end, doc, strict=True):
                seen[t.first + d].append(t.data[a:b].tobytes().decode())
        assert dict(seen) == {k: WORD.findall(t) for k, t in enumerate(texts) if t and WORD.findall(t)}


def test_equal_words_have_equal_hashes():
    one = next(chunks(pa.array(["ab ab cd AB", "cd ab"])))
    word, doc = word_hashes(one)
    assert doc.tolist() == [0, 0, 0, 0, 1, 1]
    assert word[0] == word[1] == word[3] == word[5] and word[2] == word[4] != word[0]


def test_language_on_held_out_rows(tables):
    rows = language.identify(tables.documents).join(tables.documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 200 and all(r.held_out == held(r.doc_id, 4) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out)


def test_language_of_mixed_text(tables, spark):
    docs = tables.documents
    languages, logp = language.learn(docs, language.F.lit(True))
    by = {r.lang: r.text for r in docs.where("length(text) > 1500").collect()}
    half = lambda x: x[:700]
    mixed = spark.createDataFrame([(0, half(by["en"]) + " " + half(by["de"])), (1, half(by["en"]))], "doc_id long, text string")
    got = {r.doc_id: r for r in language.predict(mixed, languages, logp).collect()}
    assert set(got[0].langs) == {"en", "de"} and abs(sum(got[0].proportions) - 1) < 1e-6 and min(got[0].proportions) > 0.3
    assert got[1].langs == ["en"]


def test_language_odd_rows(odd):
    got = language.identify(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (0, 1, 2, 3))
    assert by[8].lang_pred == "en"
    assert language.identify(odd.limit(0)).collect() == []


def test_language_without_anything_to_learn(docs):
    assert [r.lang_pred for r in language.identify(docs((0, "words here", None))).collect()] == ["und"]


def exact_encoder():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check_packing(df, rows):
    encode = exact_encoder()
    want = Counter()
    for doc_id, text in rows:
        ids = [*encode.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048
        edges = ([0] if first else []) + list(range(first, len(ids) + 1, 2048))
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want[doc_id, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    got = df.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places), sum(r.length for r in got)


def test_packing_round_trip(tables):
    n, total = check_packing(packing.pack(tables.documents), [(r.doc_id, r.text) for r in tables.documents.collect()])
    assert n <= 1.02 * math.ceil(total / 2048) + 1


def test_packing_in_groups(tables):
    check_packing(packing.pack(tables.documents, group=30), [(r.doc_id, r.text) for r in tables.documents.collect()])


def test_packing_groups_follow_the_pieces(docs):
    got = packing.pack(docs(*[prose(k, 6000) for k in range(4)]), group=10).collect()
    groups = {r.sequence_id >> 40 for r in got}
    assert len(got) > 20 and len(groups) > 1


def test_held_out_languages_are_not_counted(spark, monkeypatch):
    """Only the labels learnt from are bounded."""
    rows = [(i, prose(i, 30), f"l{i % 3}" if not held(i, 4) else f"x{i}", "s") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    assert {r.lang_pred for r in language.identify(df).collect()} <= {"l0", "l1", "l2"}
    with pytest.raises(ValueError):
        language.identify(df.withColumn("lang", df.doc_id.cast("string")))


def test_no_language_explains_random_letters(spark):
    """Learnt from the given documents: random letters go, clean held-out documents stay, whatever their length."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    noise = [(10_000 + i, " ".join("".join(rng.choice(letters, int(rng.integers(4, 12)))) for _ in range(n))) for i, n in enumerate([60, 100, 300, 3000])]  # few words tell little here
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    languages, logp = language.learn(docs, ~language.held_out(4))
    held = docs.where(language.held_out(4)).select("doc_id", "text")
    got = {r.doc_id: r.evidence for r in language.predict(held.unionAll(spark.createDataFrame(noise, held.schema)), languages, logp).collect()}
    assert all(got[i] < language.NO_LANGUAGE for i, _ in noise)
    clean = [got[r.doc_id] for r in held.collect() if r.text and len(re.findall("[a-z]", r.text)) > 0.5 * len(r.text)]
    assert len(clean) > 20 and min(clean) > language.NO_LANGUAGE


def test_packing_deals_equal_rows(spark):
    """Rows that are all alike fill as many groups as others."""
    df = spark.createDataFrame([(7, "one two three")] * 4000, "doc_id long, text string")
    groups = Counter(r.sequence_id >> 40 for r in packing.pack(df, group=400).collect())
    assert len(groups) == 10 and max(groups.values()) < 800


def test_packing_odd_rows(odd):
    check_packing(packing.pack(odd), [(r.doc_id, r.text) for r in odd.collect()])
    assert packing.pack(odd.limit(0)).collect() == []


def test_fast_ids_are_exact_ids():
    encode, exact = packing.encoder("byte_bpe_50k.json", "byte_bpe_50k.tiktoken"), exact_encoder()
    for text in ("", " a  b\n\n c", "don't I'LL 12345 ½ ²", "<|endoftext|> x", "日本語 ǅ ɐ", "\x00\x7f\x85\xa0 x", "a" * 3000):
        assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("lengths", [[5, 5, 5, 5], [7, 3, 6, 4], [10], [1] * 25, [9, 9, 9, 1, 1]])
def test_sum_of_squares(lengths):
    bins, offsets = packing.sum_of_squares(np.array(lengths), 10)
    assert len(set(bins.tolist())) == math.ceil(sum(lengths) / 10)
    for b in set(bins.tolist()):
        assert sorted(offsets[bins == b]) == [0, *np.cumsum([lengths[i] for i in sorted(np.flatnonzero(bins == b), key=lambda i: offsets[i])])[:-1]]


def check_scores(rows, got):
    count = Counter()
    for doc_id, text in rows:
        if not held(doc_id, 7):
            count.update([*(w.translate(LOWER) for w in WORD.findall(text or "")), None])
    total, distinct = sum(count.values()), len(count)
    want = Counter()
    for doc_id, text in rows:
        own = [*(w.translate(LOWER) for w in WORD.findall(text or "")), None]
        want[doc_id, held(doc_id, 7), len(own), sum(count[w] > 0 for w in own), total,
             round(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in own), 3)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in got) == want


def test_scoring(tables):
    got = scoring.scored(tables.documents).collect()
    check_scores([(r.doc_id, r.text) for r in tables.documents.collect()], got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) and all(r.score < 0 for r in got)


def test_scoring_joins_rare_words(tables, monkeypatch):
    monkeypatch.setattr(scoring, "FREQUENT", 300)
    check_scores([(r.doc_id, r.text) for r in tables.documents.collect()], scoring.scored(tables.documents).collect())


def test_scoring_odd_rows(odd):
    check_scores([(r.doc_id, r.text) for r in odd.collect()], scoring.scored(odd).collect())
    assert scoring.scored(odd.limit(0)).collect() == []


def test_model_is_normalised():
    model = scoring.Model(np.full(scoring.CLASSES, 1 / scoring.CLASSES))
    model.train(np.array([0, 0, 700]), np.array([3, 4, 5]), np.array([5, 5, 9]), 3, np.random.default_rng(0))
    table = 10.0 ** model.table().astype(float)
    assert np.allclose(table.sum(axis=1), 1, atol=1e-3) and table[700, 5] > 1 / scoring.CLASSES


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(words[i: i + 5]) for i in range(len(words) - 4))
    marked = {j for i in range(len(words) - 4) if runs[tuple(words[i: i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(marked) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked), failed


def test_quality(tables):
    got = quality.judge(tables.documents, tables.labels).collect()
    texts = {r.doc_id: r.text for r in tables.documents.collect()}
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got} == {k: base_counts(t) for k, t in texts.items()}
    assert all(not r.kept for r in got if r.base_failed)
    labels = {r.doc_id: r.quality for r in tables.labels.collect()}
    good = [r for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in got if labels.get(r.doc_id) == 0 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.95 * len(good) and sum(r.kept for r in bad) <= 0.3 * len(bad)


def test_quality_odd_rows(odd, spark):
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (None, 1, None), (8, None, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        got = quality.judge(odd, some).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter(
            (r.doc_id, *base_counts(r.text)) for r in odd.collect())
    assert quality.judge(odd.limit(0), labels).collect() == []


def test_quality_threshold_is_that_of_all_labelled_rows(spark):
    """More labelled rows than a sample would hold: the threshold is the best one over every one of them."""
    rng = np.random.default_rng(5)
    n = 24_000
    bad = rng.random(n) < 0.2
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(("#" * int(rng.integers(0, 4)) if rng.random() < (0.3 if b else 0.02) else "") + words[k].upper() * int(rng.integers(1, 3))
                      for k in rng.integers(0, 400, int(rng.integers(10, 14)))) for b in bad]
    docs = spark.createDataFrame(list(zip(range(n), texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(not b)) for i, b in enumerate(bad)], "doc_id long, quality int")
    got = quality.judge(docs, labels).where("not base_failed").collect()
    assert len(got) > 20_000
    score, good = np.array([r["anomaly"] for r in got]), np.array([not bad[r["doc_id"]] for r in got])
    levels = np.unique(score)
    lost, caught = [(len(x) - np.searchsorted(np.sort(x), levels, side="right")) / len(x) for x in (score[good], score[~good])]
    best = levels[np.where(lost <= quality.MAX_GOOD_LOST, caught - lost, -1.0).argmax()]
    assert [r["kept"] for r in got] == list(score <= best)


def test_forest_isolates_what_lies_apart():
    rng = np.random.default_rng(1)
    rows = rng.normal(0.5, 0.02, (400, 3))
    forest = quality.Forest(rows, np.zeros(3), np.ones(3))
    assert forest.score(np.array([[0.95, 0.5, 0.5]]))[0] > forest.score(rows).max()


