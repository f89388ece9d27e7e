"""Document fingerprints: threshold-scaled sketches.

A text's shingles are its runs of ``SHINGLE`` code points (a shorter text is
one shingle; an empty one has none). Every distinct shingle hash below a fixed
fraction ``1 / SCALE`` of the hash range is kept, whatever the text's length,
so sketches of parts merge by union and the share of a small document's sketch
found in a large one estimates how much of it the large one contains.

A fingerprint is the ascending hashes, 12 hex digits each, joined. Likeness is
the larger containment, |A and B| / min(|A|, |B|); where a sketch is empty it
is 1 for equal fingerprints of equal length in shingles, else 0.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import ready_workers

SHINGLE = 12
SCALE = 16
HASH_BITS = 48
#: Rows per range of doc_ids read in order, and ranges at most (their number is held by the driver).
RANGE_ROWS = 2000
MAX_RANGES = 2000

_MULTIPLIER = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def hashes(points: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """48-bit hash of every shingle, by position."""
    if not len(points):
        return np.zeros(0, dtype=np.uint64)
    n = max(1, len(points) - shingle + 1)
    x = points.astype(np.uint64) + np.uint64(1)
    # doubling: the value of a run is that of its halves, so a shingle takes log2(length) steps
    width, value, done = 1, x, None
    size = min(shingle, len(points))
    taken = 0
    while size:
        if size & 1:
            part = value[taken : taken + n]
            done = part if done is None else done * np.uint64(pow(_MULTIPLIER, width, 1 << 64)) + part
            taken += width
        size >>= 1
        if size:
            value = value[: len(value) - width] * np.uint64(pow(_MULTIPLIER, width, 1 << 64)) + value[width:]
            width *= 2
    done = done + np.uint64(min(shingle, len(points)))
    done = (done ^ (done >> np.uint64(30))) * _MIX[0]
    done = (done ^ (done >> np.uint64(27))) * _MIX[1]
    return (done ^ (done >> np.uint64(31))) >> np.uint64(64 - HASH_BITS)


def sketch(all_hashes: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Ascending distinct hashes below the threshold."""
    return np.unique(all_hashes[all_hashes < np.uint64((1 << HASH_BITS) // scale)])


def merge(*sketches: np.ndarray) -> np.ndarray:
    """Sketch of texts taken together (shingles across their borders aside)."""
    return np.unique(np.concatenate(sketches)) if sketches else np.zeros(0, dtype=np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of ``a``'s shingles that ``b`` holds; 0 if ``a``'s sketch is empty."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 0.0


def likeness(a: np.ndarray, b: np.ndarray, same: bool) -> float:
    if not len(a) or not len(b):
        return float(same)
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def encode(hashed: np.ndarray) -> str:
    wide = hashed.astype(">u8").tobytes().hex()
    skip = 16 - HASH_BITS // 4
    return "".join([wide[i + skip : i + 16] for i in range(0, len(wide), 16)])


class _Text:
    """A text's code points, shingle hashes and sketch, each computed once."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.points = code_points(self.text)
        self.hashes = hashes(self.points)
        self.sketch = sketch(self.hashes)


def edit(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first code points (or
    all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare(own: _Text, following: _Text) -> tuple:
    """n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    edited = edit(own.text, following.text)
    kept, new = len(own.text) - len(own.text) // 2, min(len(own.text) // 2, len(following.text))
    if kept >= SHINGLE and new >= SHINGLE:
        # only shingles across the joint are new: the others are the two texts' own
        joint = hashes(np.concatenate([own.points[kept - SHINGLE + 1 : kept], following.points[: SHINGLE - 1]]))
        made = sketch(np.concatenate([own.hashes[: kept - SHINGLE + 1], joint, following.hashes[: new - SHINGLE + 1]]))
    else:
        made = sketch(hashes(code_points(edited)))
    return (len(own.text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), encode(own.sketch),
            encode(made), likeness(own.sketch, made, edited == own.text),
            likeness(own.sketch, following.sketch, own.text == following.text))


def _range_number(cuts: list[int], width: int = 50):
    """How many of the ascending ``cuts`` are not above doc_id, looked up in
    two steps; rows without id belong to the last range."""
    if not cuts:
        return F.lit(0)
    listed = lambda values: "array(" + ",".join(f"{v}L" for v in values) + ")"
    coarse = f"size(filter({listed(cuts[::width])}, c -> c <= doc_id))"
    fine = (f"({coarse} - 1) * {width} + size(filter(slice({listed(cuts)}, ({coarse} - 1) * {width} + 1, {width}), "
            "c -> c <= doc_id))")
    return F.expr(f"CASE WHEN doc_id IS NULL THEN {len(cuts)} WHEN doc_id < {cuts[0]}L THEN 0 ELSE {fine} END")


def fingerprint_documents(docs: DataFrame, range_rows: int = RANGE_ROWS, max_ranges: int = MAX_RANGES) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next; ``next`` is the next document
    by ascending doc_id (after the last, the first).

    doc_ids are cut into ranges of about ``range_rows`` rows (at most
    ``max_ranges`` longer ones) from their own quantiles. Each text is dealt to
    its range once, and the first of a range also to the range before it; a
    range is sorted by Spark and streamed, two texts in memory at a time.
    Null texts are empty. Rows without doc_id come last; they, and rows of
    equal doc_id, are ordered by text. A lone document is its own next. An
    empty table gives no rows."""
    spark = docs.sparkSession
    ready_workers(spark)
    schema = StructType([StructField("doc_id", LongType()), StructField("n_chars", LongType()),
                         *[StructField(n, StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                         *[StructField(n, DoubleType()) for n in ("near_edited", "near_next")]])
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    ranges = min(max_ranges, -(-ids.count() // range_rows))
    cuts = ids.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges)) if ranges > 1 else []
    number = _range_number(sorted({int(c) for c in cuts}))
    # one row per range: its first doc_id, and the filled range before it
    heads = ids.groupBy(number.alias("number")).agg(F.min("doc_id").alias("head")).orderBy("number").collect()
    if not heads:
        return spark.createDataFrame([], schema)
    slots = heads[-1]["number"] + 1
    head, before = [None] * slots, [0] * slots
    for i, r in enumerate(heads):
        head[r["number"]], before[r["number"]] = r["head"], heads[i - 1]["number"]
    listed = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       number.alias("number"))
    own = F.struct(F.col("number").cast("long").alias("range"), F.lit(False).alias("follows"))
    ahead = F.struct(F.get(listed(before), F.col("number")).alias("range"), F.lit(True).alias("follows"))
    is_head = F.col("doc_id").eqNullSafe(F.get(listed(head), F.col("number")))
    dealt = rows.select(F.explode(F.when(is_head, F.array(own, ahead)).otherwise(F.array(own))).alias("at"),
                        "doc_id", "text").select("at.*", "doc_id", "text")
    ordered = dealt.repartition("range").sortWithinPartitions("range", "follows", F.col("doc_id").isNull(), "doc_id", "text")

    def stream(batches):
        last = None  # (range, doc_id, text) still without its next
        for batch in batches:
            out = []
            for where, follows, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if last and last[0] == where:
                    text = _Text(text)
                    out.append((last[1], *compare(last[2], text)))
                elif not follows:
                    text = _Text(text)
                last = None if follows else (where, doc_id, text)
            columns = list(zip(*out)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

    types = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2
    return ordered.mapInArrow(stream, schema)
