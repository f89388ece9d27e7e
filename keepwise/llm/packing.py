"""Best-fit packing of tokenised documents into fixed-length sequences.

Documents longer than a sequence are cut into full pieces; the first piece
takes the remainder. Pieces are then packed by the sum-of-squares rule: a
piece goes to the open sequence that leaves the sum over residual gaps g of
N(g)**2 smallest, N(g) being the number of open sequences with gap g. Largest
pieces are placed first and a sequence is opened only when no open one holds
the piece, which on lengths like these ends within about 0.2 % of the bound
total tokens / sequence length (plain online order: 1-5 % above).

Tokenising is a map over the documents. Only piece rows (a few numbers each)
are shuffled, into groups of about ``group_pieces`` that are packed
independently, so the work is spread whatever the input size.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import annotate, materialise

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 25_000
#: Characters whose classes any two Unicode tables agree on: Latin up to U+024F, without its odd spaces.
UNUSUAL = re.compile("[^\x00-\x84\x86-\x9f\xa1-\u024f]")
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class TextIds:
    """Ids of whole texts as the tokenizer file gives them. ``ranks`` names the
    same vocabulary for an encoder three times as fast; it serves texts of
    usual characters without special tokens, where both split alike."""

    def __init__(self, tokenizer: str, ranks: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast and not UNUSUAL.search(text) and not any(x in text for x in self.special):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=4)
def text_ids(tokenizer: str, ranks: str | None) -> TextIds:
    """The worker's encoder, loaded once per process (its files do not change)."""
    return TextIds(tokenizer, ranks)


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None, capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    piece = StructType([StructField(n, LongType()) for n in ("piece", "start", "length", "ids_crc32")])

    def make():
        encode = text_ids(tokenizer, ranks)

        def compute(texts):
            sizes, columns = [], ([], [], [], [])
            for t in texts:
                ids = np.append(encode(t or ""), np.array([end_id], dtype="<u4"))
                bounds = piece_bounds(len(ids), capacity)
                sizes.append(len(bounds))
                for i, (start, length) in enumerate(bounds):
                    crc = zlib.crc32(ids[start : start + length])
                    for c, v in zip(columns, (i, start, length, crc)):
                        c.append(v)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32))
            rows = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=piece.names)
            return [pa.ListArray.from_arrays(offsets, rows)]

        return compute

    cut = annotate(docs, "text", StructType([StructField("pieces", ArrayType(piece))]), make, ["doc_id"])
    return cut.select("doc_id", F.explode("pieces").alias("p")).select("doc_id", "p.*")


def sum_of_squares(lengths: Sequence[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item, placed in the order given."""
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, dtype=np.int64)
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    made = 0
    never = np.int64(1) << 40
    for i, size in enumerate(lengths):
        gap = capacity
        if size < capacity:
            # change of the sum of squares if a sequence of gap g takes the item, g = size .. capacity - 1
            now = count[size:capacity]
            change = np.where(now > 0, 2 * (count[: capacity - size] - now) + 2, never)
            if now[0]:
                change[0] = 1 - 2 * now[0]  # filled: it is no longer open
            best = int(change.argmin())
            if change[best] < never:
                gap = size + best
        if gap == capacity:
            number, made = made, made + 1
        else:
            number = open_by_gap[gap].pop()
            count[gap] -= 1
        sequence[i], offset[i] = number, capacity - gap
        if gap > size:
            open_by_gap[gap - size].append(number)
            count[gap - size] += 1
    return sequence, offset


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to piece rows.

    Rows are dealt to ``ceil(rows / group_pieces)`` groups by a hash of
    (doc_id, piece, start, crc and a row number within the task), so neither
    one source nor repeated rows make a group large."""
    cut = materialise(cut, "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    names = cut.columns
    key = F.pmod(F.xxhash64(*names, F.monotonically_increasing_id()), F.lit(groups))
    schema = StructType(cut.schema.fields + [StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def place(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        length = rows.column("length").to_numpy()
        order = np.argsort(-length, kind="stable")
        number, at = sum_of_squares(length[order].tolist(), capacity)
        sequence, offset = np.empty_like(number), np.empty_like(at)
        sequence[order], offset[order] = number, at
        group = key[0].as_py()
        return rows.select(names).append_column("sequence_id", pa.array(sequence * groups + group)).append_column(
            "offset", pa.array(offset))

    return cut.withColumn("pack_group", key).groupBy("pack_group").applyInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = CAPACITY,
                   end_id: int = END_ID, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is an empty one: a single piece holding only ``end_id``. Null
    doc_ids and repeated rows are packed like any others (each row is its own
    document). A long text only makes more pieces; of equally good places any may
    be taken; other columns are not read. An empty table gives an empty result."""
    return pack(pieces(docs, tokenizer, ranks, capacity, end_id), capacity, group_pieces)
