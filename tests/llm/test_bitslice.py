import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill.llm import bitslice
from gridmill.llm.bitslice import Slices, best, kth_greatest, quantised, signed_digits

KINDS = "vec_id long, embedding array<float>, label int"


def ranked(values, ids, query, k, own):
    score = values @ query
    order = [i for i in np.lexsort((ids, -score)).tolist() if i != own][:k]
    return order, score[order].tolist()


@pytest.mark.parametrize("value", [0, 1, -1, 3, -3, 7, 22, -23, 1000, -12345])
def test_signed_digits(value):
    digits = signed_digits(value)
    assert sum(d << p for p, d in digits) == value
    assert all(b[0] - a[0] > 1 for a, b in zip(digits, digits[1:], strict=False))


@pytest.mark.parametrize("seed", range(12))
def test_best_equals_products(seed):
    rng = np.random.default_rng(seed)
    for _ in range(12):
        n, d, most = int(rng.integers(1, 400)), int(rng.integers(1, 20)), int(rng.choice([1, 3, 40, 5000]))
        values = rng.integers(-most, most + 1, (n, d))
        if seed % 3 == 0:
            values[:, 0] = 5
        if seed % 3 == 1:
            values[: n // 2] = values[0]
        made = Slices(values)
        block = Slices.read(n, made.low.tolist(), made.width.tolist(), made.packed())
        assert (block.values() == values).all()
        ids = rng.permutation(n)
        for k in (1, 5, 20):
            query, own = values[int(rng.integers(n))], int(rng.integers(-1, n))
            for fine in (2, 64, 1 << 40):
                row, score = best(block, values, ids, query, k, own, fine)
                assert (row.tolist(), score.tolist()) == ranked(values, ids, query, k, own)


def test_sums_of_slices_are_scores():
    rng = np.random.default_rng(3)
    values, query = rng.integers(-30, 30, (200, 16)), rng.integers(-30, 30, 16)
    block = Slices(values)
    slices, lowest, rest = quantised(block, query, 1 << 40)
    assert (lowest, rest) == (0, 0)
    total = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:200].astype(np.int64) << p for p, s in enumerate(slices) if s is not None), np.zeros(200, np.int64))
    scores = values @ query
    assert len(set((scores - total).tolist())) == 1
    assert kth_greatest(slices, 7, block.valid) == sorted(total.tolist())[-7]
    coarse, lowest, rest = quantised(block, query, 16)
    total = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:200].astype(np.int64) << (p + lowest) for p, s in enumerate(coarse) if s is not None), np.zeros(200, np.int64))
    gap = (scores - total) - (scores - total).min()
    assert lowest > 0 and gap.max() <= rest


def expected(rows, every, k):
    import math
    good = [(i, v, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, _, x) in enumerate(good):
        if i % every == 0:
            scores = sorted((-sum(p * q for p, q in zip(x, y, strict=False)), j) for b, (j, _, y) in enumerate(good) if b != a)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block,queries", [(1 << 15, 512), (40, 3)])
def test_whole_search(spark, block, queries):
    rng = np.random.default_rng(11)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.15, 12)]) for i in range(150)]
    rows += [(20, rows[20][1]), (20, rows[3][1]), (7, rows[7][1])]  # a repeated row, a repeated number
    rows += [(160, None), (161, [0.5, None, 0.1]), (180, [float("nan")] * 12), (181, [float("inf"), 0.0]), (None, rows[0][1])]
    rows += [(200, []), (201, [1.0, -0.25]), (220, [0.3] * 14)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], KINDS)
    for name in ("id", "x", "row", "block", "part", "score", "rank"):
        df = df.withColumn(name, F.lit("x"))
    got = bitslice.top_products(df, 20, 20, block=block, queries=queries)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == expected(rows, 20, 20)


def test_few_rows_and_none(spark):
    rows = [(40, [0.5, -0.5]), (3, [0.25, 0.25])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], KINDS)
    assert [tuple(r) for r in bitslice.top_products(df, 20, 20).collect()] == [(40, 1, 3, 0)]
    assert bitslice.top_products(df.limit(0), 20, 20).collect() == []
    assert bitslice.top_products(df.where("vec_id = 3"), 20, 20).collect() == []
    with pytest.raises(OverflowError):
        bitslice.top_products(spark.createDataFrame([(20, [1e30], 1)], KINDS), 20, 20)
