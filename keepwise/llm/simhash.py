"""SimHash near-duplicate detection.

Fingerprints: 64-bit SimHash over 3-word shingles (XXH64, seed 42). Linking:
each fingerprint is embedded as its vector of per-segment bit counts. Flipping
one bit moves the vector by exactly one step of Manhattan distance, so two
fingerprints within ``max_distance`` bits lie within that Manhattan distance:
a lower bound that a grid range-join can search. With at most two steps
between two vectors there is a grid cell within one step of both, so each
side is dealt to its own cell and the cells one step away, equal cells meet
in an equi-join, and the exact Hamming distance is verified inside the join.

Only distinct fingerprints are joined, so copies cost one row however many
there are, and the links per fingerprint are bounded by the 2,080 codes within
two bits. No link between different fingerprints is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import annotate, col, materialise, shuffled

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
#: Shingles hashed between two bit counts: bounds the memory of one long text.
CHUNK = 100_000


def simhash64(text: str | None) -> int:
    """Unsigned 64-bit fingerprint; zero for null or wordless texts."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) < SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - SHINGLE_WORDS + 1
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, CHUNK):
        part = words[i : min(i + CHUNK, n) + SHINGLE_WORDS - 1]
        hashes = b"".join([digest(b"%b %b %b" % t, SEED) for t in zip(part, part[1:], part[2:])])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, keep=("doc_id",), text: str = "text", name: str = "fp") -> DataFrame:
    """``keep`` columns and the fingerprint (signed 64-bit) of each row's text."""

    def make():
        def compute(texts):
            out = np.fromiter((simhash64(t) for t in texts), dtype=np.uint64, count=len(texts))
            return [pa.array(out.view(np.int64))]

        return compute

    return annotate(docs, text, StructType([StructField(name, LongType())]), make, keep)


def segment_counts(fp):
    """Bits set in each of the sixteen 4-bit segments, one hex digit each."""
    odd, even = F.lit(0x5555555555555555), F.lit(0x3333333333333333)
    a, b = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    pairs = a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))
    return pairs.bitwiseAND(even) + F.shiftrightunsigned(pairs, 2).bitwiseAND(even)


def _cells(point):
    """The point's own grid cell and those one Manhattan step away."""
    steps = []
    for i in range(0, 64, 4):
        digit = F.shiftrightunsigned(point, i).bitwiseAND(F.lit(15))
        # the digit is 0 to 4: rewritten by exclusive or, as adding in the top digit would overflow
        up = point.bitwiseXOR(F.shiftleft(digit.bitwiseXOR(digit + 1), i))
        down = point.bitwiseXOR(F.shiftleft(digit.bitwiseXOR(digit - 1), i))
        steps += [F.when(digit < 4, up), F.when(digit > 0, down)]
    return F.array_compact(F.array(point, *steps))


def near_pairs(fps: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs ``(u, v)``, u < v, of the distinct fingerprints ``fp`` that differ
    in at most ``max_distance`` (0 to 2) bits."""
    if not 0 <= max_distance <= 2:
        raise ValueError("the one-step cell join covers at most two differing bits")
    point = segment_counts(F.col("fp"))
    cells = fps.select("fp", F.explode(_cells(point)).alias("cell"))
    a = cells.select(F.col("cell"), F.col("fp").alias("u"))
    b = cells.select(F.col("cell").alias("cell_b"), F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_distance
    # Spark sizes the exploded cells as their fingerprints, up to 33 times too low
    pairs = a.join(shuffled(b), (F.col("cell") == F.col("cell_b")) & (F.col("u") < F.col("v")) & near)
    return pairs.select("u", "v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of the edges ``(u, v)``; root is the
    smallest node reachable. Alternates large-star and small-star rewrites,
    each a grouped minimum and a join, until the edges form stars. Every round
    is written to the shared folder, so lineage stays short."""
    e = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v"), "edges")

    def signature(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = signature(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.join(shuffled(low), F.col("u") == F.col("k")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(shuffled(low2), F.col("u") == F.col("k"))
        e = materialise(small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                       F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                        .select("x.u", "x.v").where("u > v").distinct(), "edges")
        after = signature(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def components(marked: DataFrame) -> DataFrame:
    """``(doc_id, fp, component_id)`` for rows ``(doc_id, fp)``; component_id
    is the smallest doc_id reachable through links, its own included. Null
    doc_ids link like any other but never name a component (null only if the
    component has no other doc_id). Repeated rows stay repeated."""
    marked = materialise(marked.select("doc_id", "fp"), "fp")
    rooted = _rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(shuffled(named), "root").select("fp", "component_id")
    return marked.join(shuffled(labels), "fp").select("doc_id", "fp", "component_id")


def _rooted(heads: DataFrame) -> DataFrame:
    """``heads`` (one row per fingerprint ``fp``) with ``root``, the same for all linked fingerprints."""
    heads = materialise(heads, "heads")
    roots = connected_components(near_pairs(heads.select("fp")))
    return heads.join(shuffled(roots), heads.fp == roots.node, "left").select(*heads.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.
    Null and wordless texts have fingerprint zero, linked like any other.
    Repeated rows stay repeated; texts of any length are read whole, in pieces;
    other columns are not read; an empty table gives an empty result."""
    out = components(fingerprints(docs))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one document of each near-duplicate group: the
    smallest doc_id, and of rows that share it the smallest fingerprint, then
    text hash. Rows that repeat doc_id and text are reduced to one; a doc_id
    with unlike texts stands for several groups and keeps a row in each. Rows
    without doc_id cannot be told apart by it and are all kept."""
    of_text = F.xxhash64(col("text"), F.length(col("text")))
    marked = fingerprints(docs.select(col("doc_id"), col("text"), of_text.alias("t")), keep=("doc_id", "t"))
    marked = materialise(marked.where("doc_id is not null"), "fp")
    rooted = _rooted(marked.groupBy("fp").agg(F.min(F.struct("doc_id", "fp", "t")).alias("head")))
    heads = materialise(rooted.groupBy("root").agg(F.min("head").alias("h")).select("h.doc_id", "h.t"), "kept")
    named = shuffled(heads.select(F.col("doc_id").alias("keepwise_keep_id"), F.col("t").alias("keepwise_keep_t")))
    # repeated rows are reduced before the shuffle, whose partitioning the join then uses
    repeats = Window.partitionBy(col("doc_id"), F.col("keepwise_t")).orderBy(F.xxhash64(*map(col, docs.columns)))
    first = (docs.where(col("doc_id").isNotNull()).withColumn("keepwise_t", of_text)
             .withColumn("keepwise_n", F.row_number().over(repeats)).where("keepwise_n = 1"))
    kept = first.join(named, (col("doc_id") == F.col("keepwise_keep_id")) & (F.col("keepwise_t") == F.col("keepwise_keep_t")),
                      "left_semi").select(*map(col, docs.columns))
    return kept.unionByName(docs.where(col("doc_id").isNull()))
