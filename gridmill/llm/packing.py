"""Best-fit packing of documents into sequences by the sum-of-squares rule.

Documents become token pieces of at most ``capacity`` tokens. A piece goes where it makes the sum, over all gaps, of
the squared number of open sequences with that gap smallest. The state is one counter per gap, so a choice costs
``capacity`` steps whatever the number of sequences.

Pieces are dealt over groups by a hash of their row number in a written table; groups are packed apart, and the number of
groups follows the number of pieces. A group holds about ``GROUP`` pieces of random length, so what its last open sequences waste
is a small share of it. Nothing a piece holds decides its group, so no key and no repeated row can make a group large.

Null and empty texts are the end token alone. Rows of one document number are packed each for itself. Null document
numbers are kept. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridmill.session import checkpointed

CAPACITY = 2048
#: Pieces that are packed together.
GROUP = 40_000

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary())])
_encoders: dict = {}


class Encoder:
    """Token numbers of a text, as the tokenizer file gives them without added special tokens.

    The rank file of the same vocabulary is several times faster. It is used where both agree by construction: texts
    without the special token's string and with characters of the oldest blocks only, which all Unicode versions
    class alike. Any other text goes to the tokenizer file itself.
    """

    def __init__(self, name: str, ranks: str | None):
        import public_tokenizers

        self.file = public_tokenizers.path(name)
        self.fast = None
        if ranks:
            import regex
            import tiktoken

            with open(public_tokenizers.path(ranks), "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            self.other = regex.compile(r"[^\x00-ɏ]|<\|")

    @cached_property
    def exact(self):
        """The tokenizer file, read when a text first needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.file)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not self.other.search(text):
            return np.asarray(self.fast.encode_ordinary(text), "<u4")
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, "<u4")


def encoder(name: str, ranks: str | None) -> Encoder:
    if (name, ranks) not in _encoders:
        _encoders[name, ranks] = Encoder(name, ranks)
    return _encoders[name, ranks]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and end of the pieces of n tokens: all full but the first, which takes what is over."""
    rest = n % capacity
    edges = ([0] if rest else []) + list(range(rest, n + 1, capacity))
    return list(zip(edges, edges[1:], strict=False))


def pieces(docs: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", ranks: str | None = "byte_bpe_50k.tiktoken",
           capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Token pieces: doc_id, piece, start, length, ids (little-endian unsigned 32-bit numbers)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks)
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for k, (a, b) in enumerate(cuts(len(ids), capacity)):
                    rows.append((doc_id, k, a, b - a, ids[a:b].tobytes()))
                held += ids.nbytes
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECES.types, strict=True)], schema=PIECES)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECES.types, strict=True)], schema=PIECES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids binary")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length, taken longest first."""
    open_bins: dict[int, list[int]] = defaultdict(list)
    count = np.zeros(capacity + 1, np.int64)
    fill: list[int] = []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        # Change of the sum if an open sequence of gap g takes the piece: it leaves g and, unless full, joins g - size.
        change = 2 * (count[: capacity - size + 1] - count[size:]) + 2
        change[0] = 1 - 2 * count[size]
        change[count[size:] == 0] = np.iinfo(np.int64).max
        change[-1] = 2 * count[capacity - size] + 1 if size < capacity else 0  # a new sequence
        left = int(change.argmin())
        gap = left + size
        if gap == capacity:
            at = len(fill)
            fill.append(0)
        else:
            at = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = at, fill[at]
        fill[at] += size
        if left:
            open_bins[left].append(at)
            count[left] += 1
    return bins, offsets


def place(cut: DataFrame, n_groups: int, *, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to token pieces that have doc_id, piece and length; other columns stay.

    ``cut`` is a table that is written already (a checkpoint, or files): its rows keep their numbers when a task is run again.
    """
    kinds = cut.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + ", sequence_id long, offset long"

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        group = table.column("_group")[0].as_py()
        table = table.drop_columns(["_group"])
        bins, offsets = sum_of_squares(table.column("length").to_numpy(), capacity)
        return table.append_column("sequence_id", pa.array(bins + (group << 40))).append_column("offset", pa.array(offsets))

    deal = F.pmod(F.xxhash64("_row"), F.lit(max(1, n_groups)))
    numbered = cut.withColumn("_row", F.monotonically_increasing_id()).withColumn("_group", deal).drop("_row")
    return numbered.groupBy("_group").applyInArrow(pack, schema)


def pack(docs: DataFrame, *, group: int = GROUP, capacity: int = CAPACITY, **options) -> DataFrame:
    """Every piece with its checksum and place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Join ``pieces`` to it on doc_id and piece to write the sequences themselves.
    """
    # Kept, as the number of groups follows that of the pieces: a long text has many.
    cut = checkpointed(pieces(docs, capacity=capacity, **options).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return place(cut, -(-cut.count() // group), capacity=capacity)
