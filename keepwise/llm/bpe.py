"""BPE encoding and decoding through a distinct-word table.

A byte-pair vocabulary that drops white space encodes every white-space
delimited word on its own, so a corpus needs one encoding per distinct word:

1. texts are dealt to blocks (a hash of the row), once;
2. every block lists its distinct words, cut into word-hash buckets;
3. a bucket gathers its words from all blocks: each distinct word of the
   corpus is in one bucket and is encoded there once;
4. the ids go back to the blocks and are joined to the words by position.

Lists travel as one compressed row per block and bucket, not as a row per
word, so frequent words cost a place in a list per block and no bucket or
block depends on how often a word occurs. Decoding joins ids with the
vocabulary's id-to-piece table: by Spark in ``decode``, and inside the blocks
by place in the same table (its size is the vocabulary's).
"""

from __future__ import annotations

import hashlib
import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ready_workers

#: Bytes of text in a block (about), and buckets at most.
BLOCK_BYTES = 20_000_000
MAX_BUCKETS = 1024
#: zstd level of the lists: they are written once and read once.
LEVEL = 9


class WordTokenizer:
    """The tokenizer file, for one word at a time, and its id-to-piece table."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.pieces = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.numbers = [str(i) for i in range(size)]
        self.dtype, self.width = ("<u2", 2) if size <= 1 << 16 else ("<u4", 4)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, packed."""
        made = self.tokenizer.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in words],
                                                add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in made]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """Loaded once per worker process (the file does not change)."""
    return WordTokenizer(path)


def split_words(text: str | None) -> list[bytes]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed and
    carriage return. Other white space stays for the tokenizer to drop."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def bucketed(words: set[bytes], buckets: int) -> dict[int, list[bytes]]:
    """The words by bucket, ascending in each: the order both sides rely on."""
    out: dict[int, list[bytes]] = {}
    for w in words:
        out.setdefault(zlib.crc32(w) % buckets, []).append(w)
    for listed in out.values():
        listed.sort()
    return out


def _packed(parts: list[bytes], width: int) -> bytes:
    """Number of ids of each part (two bytes; long ones in eight behind) and the parts, compressed."""
    counts = np.array([len(p) // width for p in parts], dtype=np.int64)
    long = counts[counts >= 0xFFFF]
    head = np.minimum(counts, 0xFFFF).astype("<u2").tobytes() + long.astype("<i8").tobytes()
    return zstandard.ZstdCompressor(LEVEL).compress(head + b"".join(parts))


def _unpacked(data: bytes, n: int, width: int) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    counts = np.frombuffer(raw[: 2 * n], dtype="<u2").astype(np.int64)
    long = np.flatnonzero(counts == 0xFFFF)
    counts[long] = np.frombuffer(raw[2 * n : 2 * n + 8 * len(long)], dtype="<i8")
    edges = np.concatenate([[0], np.cumsum(counts * width)]) + 2 * n + 8 * len(long)
    return [raw[i:j] for i, j in zip(edges[:-1].tolist(), edges[1:].tolist())]


def encode_documents(docs: DataFrame, tokenizer: str, keep_ids: bool = False,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and with
    ``keep_ids`` also ids and decoded.

    A null text is an empty one: no ids, the digests of the empty string. Null
    doc_ids and repeated rows stay as they are. Texts of any length are encoded
    whole; other columns, whatever their names, are not read. An empty table
    gives none."""
    spark = docs.sparkSession
    ready_workers(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // block_bytes
    buckets = int(min(MAX_BUCKETS, max(32, blocks)))
    blocked = rows.select("doc_id", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block")
                          ).repartition("block")

    def list_words(batches):
        held: dict[int, set[bytes]] = {}
        for batch in batches:
            for block, text in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(block, set()).update(split_words(text))
        for block, words in held.items():
            lists = bucketed(words, buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(lists), pa.int64()), pa.array(list(lists), pa.int32()),
                 pa.array([len(x) for x in lists.values()], pa.int64()),
                 pa.array([zstandard.ZstdCompressor(LEVEL).compress(b" ".join(x)) for x in lists.values()], pa.binary())],
                names=["block", "bucket", "n", "words"])

    def encode_lists(batches):
        model = word_tokenizer(tokenizer)
        known: dict[bytes, bytes] = {}
        for batch in batches:
            made = []
            for data in batch.column(3).to_pylist():
                words = zstandard.ZstdDecompressor().decompress(data).split()
                new = [w for w in words if w not in known]
                known.update(zip(new, model.encode(new)))
                made.append(_packed([known[w] for w in words], model.width))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.binary())],
                                             names=["own_block", "bucket", "n", "ids"])

    def join_back(texts: pa.Table, lists: pa.Table) -> pa.Table:
        model = word_tokenizer(tokenizer)
        distinct: set[bytes] = set()
        for text in texts.column("text"):  # split again below: the words of a block are many times its text in memory
            distinct.update(split_words(text.as_py()))
        mine = bucketed(distinct, buckets)
        numbers: dict[bytes, str] = {}
        pieces: dict[bytes, str] = {}
        for bucket, data in zip(lists.column("bucket").to_pylist(), lists.column("ids").to_pylist()):
            words = mine[bucket]
            for word, packed in zip(words, _unpacked(data, len(words), model.width)):
                ids = np.frombuffer(packed, dtype=model.dtype).tolist()
                numbers[word] = " ".join([model.numbers[i] for i in ids])
                pieces[word] = " ".join([model.pieces[i] for i in ids])
        silent = {w for w, ids in numbers.items() if not ids}
        out: list[list] = [[] for _ in range(5)]
        for text in texts.column("text"):
            words = split_words(text.as_py())
            if silent:
                words = [w for w in words if w not in silent]
            ids, decoded = " ".join(map(numbers.__getitem__, words)), " ".join(map(pieces.__getitem__, words))
            out[0].append(ids.count(" ") + 1 if ids else 0)
            out[1].append(hashlib.sha256(ids.encode()).hexdigest())
            out[2].append(hashlib.sha256(decoded.encode()).hexdigest())
            if keep_ids:
                out[3].append(list(map(int, ids.split())))
                out[4].append(decoded)
        columns = [texts.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()),
                   pa.array(out[2], pa.string())]
        if keep_ids:
            columns += [pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4], pa.string())]
        return pa.table(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (
        ", ids array<long>, decoded string" if keep_ids else "")
    names = [f.split(" ")[0] for f in schema.split(", ")]
    # all columns of ``blocked`` on both paths, so that its shuffle is made once and read twice
    listed = blocked.mapInArrow(list_words, "block long, bucket int, n long, words binary")
    encoded = listed.repartition(buckets, "bucket").mapInArrow(encode_lists,
                                                               "own_block long, bucket int, n long, ids binary")
    return blocked.groupBy("block").cogroup(encoded.groupBy("own_block")).applyInArrow(join_back, schema)


def piece_table(spark: SparkSession, tokenizer: str) -> DataFrame:
    """(id, piece) of every id of the vocabulary."""
    return spark.createDataFrame(list(enumerate(word_tokenizer(tokenizer).pieces)), "id long, piece string")


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, decoded) of rows (key, ids): every id is joined with its piece and
    the pieces are put back in order, a space apart. The piece table is as
    large as the vocabulary, so it is broadcast. Rows of null ids give null;
    rows with the same key are told apart by their content."""
    pieces = piece_table(encoded.sparkSession, tokenizer)
    rows = encoded.select(F.col(key), F.col(ids).alias("ids")).groupBy(key, "ids").agg(F.count(F.lit(1)).alias("times"))
    placed = rows.where("size(ids) > 0").select(key, "ids", "times", F.posexplode("ids").alias("at", "id"))
    joined = placed.join(F.broadcast(pieces), "id").groupBy(key, "ids", "times").agg(
        F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("parts"))
    made = joined.select(key, "times", F.array_join(F.transform("parts", lambda p: p["piece"]), " ").alias("decoded"))
    rest = rows.where("ids is null or size(ids) = 0").select(key, "times", F.when(F.col("ids").isNotNull(), "").alias("decoded"))
    return made.unionByName(rest).select(key, "decoded", F.explode(F.sequence(F.lit(1), "times"))).drop("col")
