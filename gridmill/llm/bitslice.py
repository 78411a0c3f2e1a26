"""Exact top-k inner products over a bit-sliced index.

The index holds blocks of rows. In a block every component is an attribute: its values less the block's least, cut into binary
slices, one bitmap over the block's rows for each binary digit.

1. A query's component is written in signed digits. Each digit adds the attribute's slices to the score, moved up by the digit's
   place; a negative digit adds their complement. Scores of all rows of a block are added at once with bitmap arithmetic: three
   bitmaps of one place become one of that place and a carry, until each place has one.
2. Slices of the lowest places are left out (the attributes are quantised) as long as all of them together stay below a
   ``1 / FINE`` of the greatest score. What they can add at most is known exactly.
3. The k-th greatest quantised score is found from the most significant slice of the sum downward. Rows that cannot reach it even
   with all that was left out are dismissed with bitmap comparisons.
4. The rows at the boundary and above get their exact scores, and the k best of the block stay.

Blocks of queries meet blocks of the index by a join of block numbers; the best of all blocks are ranked by Spark. Each row goes to a
block by its number in a written table, so repeated rows are spread like others. A task holds one index block and one query block.

Rows that are null, without a number, or hold a null or a component that is not finite take no part. Missing components of a shorter
vector count as 0. Repeated rows are rows of their own: a query leaves out itself only. Scores beyond 64 bits are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridmill.session import scratch

#: Rows of an index block, queries of a query block, and the share of the greatest score that may be left out at first.
BLOCK, QUERIES, FINE = 1 << 15, 512, 64
#: Numbers of at most so many bits, so that products of them are exact.
BITS = 30


def signed_digits(value: int) -> list[tuple[int, int]]:
    """(place, 1 or -1) of the digits that are not 0; no two are neighbours."""
    out, place = [], 0
    while value:
        if value & 1:
            digit = 2 - (value & 3)
            out.append((place, digit))
            value -= digit
        value >>= 1
        place += 1
    return out


class Slices:
    """Bitmaps of a block's attributes and their complements."""

    def __init__(self, values: np.ndarray):
        """values: a row of integers for each row of the block."""
        self.rows = len(values)
        self.low = values.min(axis=0).astype(np.int64)
        above = values.astype(np.int64) - self.low
        self.width = np.array([int(x).bit_length() for x in above.max(axis=0)], np.int64)
        planes = [(above[:, d] >> j & 1).astype(np.uint8) for d in range(values.shape[1]) for j in range(self.width[d])]
        self._fill(np.packbits(np.stack(planes), axis=1, bitorder="little") if planes else np.zeros((0, -(-self.rows // 8)), np.uint8))

    def _fill(self, packed: np.ndarray) -> None:
        words = -(-self.rows // 64)
        padded = np.zeros((len(packed), words * 8), np.uint8)
        padded[:, : packed.shape[1]] = packed
        self.plane = padded.view(np.uint64)
        self.inverse = ~self.plane
        self.first = np.r_[0, np.cumsum(self.width)]
        self.valid = np.zeros(words * 8, np.uint8)
        self.valid[: -(-self.rows // 8)] = np.packbits(np.ones(self.rows, np.uint8), bitorder="little")
        self.valid = self.valid.view(np.uint64)

    def packed(self) -> bytes:
        return self.plane.tobytes()

    @classmethod
    def read(cls, rows: int, low: list[int], width: list[int], packed: bytes) -> Slices:
        self = cls.__new__(cls)
        self.rows, self.low, self.width = rows, np.array(low, np.int64), np.array(width, np.int64)
        self._fill(np.frombuffer(packed, np.uint8).reshape(int(self.width.sum()), -(-rows // 64) * 8))
        return self

    def values(self) -> np.ndarray:
        """The integers back from their slices."""
        out = np.zeros((self.rows, len(self.low)), np.int64)
        for d in range(len(self.low)):
            for j in range(self.width[d]):
                out[:, d] += np.unpackbits(self.plane[self.first[d] + j].view(np.uint8), bitorder="little")[: self.rows].astype(np.int64) << j
        return out + self.low


def added(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum of bitmaps, columns[p] those of place p, by carry-save addition."""
    out = []
    place = 0
    while place < len(columns):
        column = columns[place]
        while len(column) > 1:
            if place + 1 == len(columns):
                columns.append([])
            a, b = column.pop(), column.pop()
            half = a ^ b
            a = a & b
            if column:
                c = column.pop()
                b = half & c
                a |= b
                half ^= c
            columns[place + 1].append(a)
            # Sums wait behind the others, so that the chain stays short.
            column.insert(0, half)
        out.append(column[0] if column else None)
        place += 1
    return out


def quantised(block: Slices, query: np.ndarray, fine: int = FINE) -> tuple[list[np.ndarray], int, int]:
    """Slices of the scores' quantised part, its lowest place, and the most that was left out (in units of the score)."""
    places: list[list[np.ndarray]] = []
    for d, value in enumerate(query.tolist()):
        first, width = int(block.first[d]), int(block.width[d])
        if not width:
            continue
        for shift, digit in signed_digits(value):
            source = block.plane if digit > 0 else block.inverse
            while len(places) < shift + width:
                places.append([])
            for j in range(width):
                places[shift + j].append(source[first + j])
    most = sum(len(column) << p for p, column in enumerate(places))
    lowest = rest = 0
    while lowest < len(places) and rest + (len(places[lowest]) << lowest) <= most // fine:
        rest += len(places[lowest]) << lowest
        lowest += 1
    return added(places[lowest:]), lowest, rest


def at_least(slices: list[np.ndarray], bound: int, valid: np.ndarray) -> np.ndarray:
    """Bitmap of the rows whose sum is ``bound`` at least, from the most significant slice downward."""
    if bound <= 0:
        return valid
    if bound >> len(slices):
        return np.zeros_like(valid)
    more, same = np.zeros_like(valid), valid.copy()
    for p in range(len(slices) - 1, -1, -1):
        one = slices[p]
        if bound >> p & 1:
            same = same & one if one is not None else np.zeros_like(valid)
        elif one is not None:
            more |= same & one
            same = same & ~one
    return more | same


def kth_greatest(slices: list[np.ndarray], k: int, valid: np.ndarray) -> int:
    """The k-th greatest sum; 0 if there are fewer rows."""
    above, same, value = np.zeros_like(valid), valid, 0
    for p in range(len(slices) - 1, -1, -1):
        if slices[p] is None:
            continue
        one = same & slices[p]
        if int(np.bitwise_count(above | one).sum()) >= k:
            same, value = one, value | 1 << p
        else:
            above = above | one
            same = same & ~slices[p]
    return value


def best(block: Slices, values: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int, own: int = -1, fine: int = FINE) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the block with the k greatest scores, equal ones by smaller id, and the scores. own: the row to leave out."""
    valid = block.valid
    if own >= 0:
        valid = valid.copy()
        valid[own >> 6] &= ~np.uint64(1 << (own & 63))
    slices, lowest, rest = quantised(block, query, fine)
    bound = kth_greatest(slices, k, valid)
    # k rows have the k-th sum or more; a row with less can have as much only by what was left out.
    near = at_least(slices, bound - (rest >> lowest), valid)
    row = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))
    score = values[row] @ query
    order = np.lexsort((ids[row], -score))[:k]
    return row[order], score[order]


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * component) of every component, each a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or a component that is not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def top_products(rows: DataFrame, every: int, k: int, *, key: str = "vec_id", vector: str = "embedding", scale: int = 64, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, the partner's number and score: the k greatest inner products of each row whose number ``every`` divides.

    Vectors are compared as integers, floor(scale * component).
    """
    spark = rows.sparkSession
    path = scratch(spark, "vectors")
    # The numbers are written once, so a task that is run again later finds the same.
    rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & usable(F.col("v"))).select(
        "id", integers(F.col("v"), scale).alias("x"), F.monotonically_increasing_id().alias("row")).write.parquet(path)
    held = spark.read.parquet(path)
    n, n_queries, dims, far = held.agg(
        F.count("*"), F.count_if(F.col("id") % every == 0), F.coalesce(F.max(F.size("x")), F.lit(0)),
        F.coalesce(F.max(F.array_max(F.transform("x", F.abs))), F.lit(0))).first()
    blocks, parts = max(1, -(-n // block)), max(1, -(-n_queries // queries))
    if far >> BITS or dims * far * far >> 62:
        raise OverflowError(f"components up to {far} / {scale} in {dims} dimensions: scores do not fit into 64 bits")

    def matrix(vectors: pa.ChunkedArray) -> np.ndarray:
        lists = vectors.combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        out = np.zeros((len(size), dims), np.int64)
        out[np.arange(dims) < size[:, None]] = lists.flatten().to_numpy()
        return out

    def build(table: pa.Table) -> pa.Table:
        sliced = Slices(matrix(table.column("x")))
        return pa.table({
            "block": table.column("block").slice(0, 1), "ids": [table.column("id").to_numpy().tobytes()], "rows": [table.column("row").to_numpy().tobytes()],
            "low": pa.array([sliced.low], pa.list_(pa.int64())), "width": pa.array([sliced.width], pa.list_(pa.int64())), "slices": pa.array([sliced.packed()], pa.binary())})

    def dealt(count: int, label: str) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(label)), F.lit(count)).cast("int")

    index = scratch(spark, "slices")
    held.withColumn("block", dealt(blocks, "block")).repartition(min(blocks, 4096), "block").groupBy("block").applyInArrow(
        build, "block int, ids binary, rows binary, low array<long>, width array<long>, slices binary").write.parquet(index)

    def search(asked: pa.Table, found: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        out: list[list[np.ndarray]] = [[none], [none], [none], [none]]
        if len(found) and len(asked):
            one = found.slice(0, 1).to_pylist()[0]
            ids, numbers = np.frombuffer(one["ids"], np.int64), np.frombuffer(one["rows"], np.int64)
            sliced = Slices.read(len(ids), one["low"], one["width"], one["slices"])
            values = sliced.values()
            order = np.argsort(numbers)
            questions = matrix(asked.column("x"))
            for i, (query, row) in enumerate(zip(asked.column("id").to_pylist(), asked.column("row").to_pylist(), strict=True)):
                at = int(np.searchsorted(numbers, row, sorter=order))
                own = int(order[at]) if at < len(order) and numbers[order[at]] == row else -1
                near, score = best(sliced, values, ids, questions[i], k, own)
                for x, y in zip(out, (np.full(len(near), query), np.full(len(near), row), ids[near], score), strict=True):
                    x.append(y)
        return pa.table({name: pa.array(np.concatenate(x), pa.int64()) for name, x in zip(("query_id", "query_row", "id", "score"), out, strict=True)})

    tasks = min(blocks * parts, 4096)
    asked = held.where(F.col("id") % every == 0).withColumn("part", dealt(parts, "part")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, "block", "part")
    there = spark.read.parquet(index).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(tasks, "block", "part")
    found = asked.groupBy("block", "part").cogroup(there.groupBy("block", "part")).applyInArrow(
        search, "query_id long, query_row long, id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(key), "score")
