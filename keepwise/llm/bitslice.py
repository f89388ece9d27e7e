"""Exact top-k inner products by a bit-sliced index.

Components are quantised to integers, floor(256 * x). The index holds, for a
part of the rows, every attribute (dimension) as an offset and bit slices: one
bitmap over the part's distinct vectors for each binary digit of the offset
value. A query is answered in three steps:

* add: the slices of each attribute are added up with bitmap arithmetic, once
  for every binary digit of the query's component, shifted by its place (for a
  negative component the inverted slices are added instead, which differs by a
  constant of the query). Slices of equal weight are reduced three to two by
  full adders, so the sum is itself a bit-sliced attribute. Only the ``SLICES``
  highest slices take part; what the lower ones could add has a known bound;
* select: from the most significant slice of the sum downward the bitmap of
  candidates is split by the slice's bit and counted, which gives the value of
  the k-th best sum; all rows whose sum is less than the bound below it are the
  boundary;
* resolve: rows of the boundary are rebuilt from all their slices and ranked by
  the exact integer inner product, ties by id.

Nothing is approximate: a row outside the boundary cannot be among the best k.
Every part's best k + 1 are merged per query. The work is (query vectors) x
(rows) / 64 bitmap words, dealt as (part of the rows, part of the queries);
equal query vectors are searched once, equal vectors of a part stand once in
its index with their ids, so a hot vector costs no more than any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, ready_workers

K = 5
EVERY = 50
SCALE = 256
#: Highest slices of an attribute that are added; the others serve the exact ranks.
SLICES = 7
#: Rows of one part of the index and query vectors searched against it at once.
PART_ROWS = 65_536
QUERY_ROWS = 4_096
#: 64-bit words per bitmap operation: small enough to stay in a core's cache.
PASS_WORDS = 8_192
_ALL = np.uint64(2**64 - 1)
_INDEX = ("part int, dim int, size int, width int, words int, low array<bigint>, slices binary, "
          "ids array<bigint>, ends array<int>")


def quantised(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, x), x = floor(256 * component) as array of long.
    Without rows that take no part: null ids, null vectors, null or non-finite
    components."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), bad.alias("bad"))
            .where("vec_id is not null and v is not null and not bad")
            .select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long")).alias("x")).distinct())


def slice_attributes(x: np.ndarray) -> tuple[np.ndarray, int, int, np.ndarray]:
    """Index of the rows of ``x``: least value per attribute, number of slices,
    words per bitmap, and the bitmaps [attribute, slice, word], least
    significant slice first."""
    n, dim = x.shape
    low = x.min(axis=0)
    offset = x.astype(np.uint64) - low.astype(np.uint64)
    width = int(offset.max(initial=0)).bit_length()
    words = -(-n // 64)
    bits = np.zeros((dim, width, words * 8), dtype=np.uint8)
    for s in range(width):
        packed = np.packbits(((offset >> np.uint64(s)) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little")
        bits[:, s, : packed.shape[1]] = packed
    return low, width, words, bits.view(np.uint64)


def rebuild(low: np.ndarray, slices: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact vectors of the given rows, read back from their slices."""
    out = np.repeat(low.astype(np.uint64)[None, :], len(rows), axis=0)
    word, bit = rows >> 6, (rows & 63).astype(np.uint64)
    for s in range(slices.shape[1]):
        out += (((slices[:, s, :][:, word] >> bit) & np.uint64(1)) << np.uint64(s)).T
    return out.view(np.int64)


def _full_add(a, b, c):
    """Sum and carry of three bitmaps."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def add_slices(queries: np.ndarray, slices: np.ndarray, drop: int) -> list[np.ndarray]:
    """Bit slices [query, word] of the sum over all attributes of |q| * y,
    least significant first, where y is the attribute's offset value without
    its lowest ``drop`` digits, or for negative q its complement."""
    size = np.abs(queries)
    negative = (queries < 0).any(axis=0)
    columns: dict[int, list] = {}

    def put(weight, bitmap):
        column = columns.setdefault(weight, [])
        column.append(bitmap)
        while len(column) >= 3:
            total, carry = _full_add(column.pop(), column.pop(), column.pop())
            column.append(total)
            put(weight + 1, carry)

    for d in range(slices.shape[0]):
        digits = int(size[:, d].max(initial=0)).bit_length()
        flip = np.where(queries[:, d] < 0, _ALL, np.uint64(0))[:, None] if negative[d] else None
        takes = [np.where((size[:, d] >> b) & 1 == 1, _ALL, np.uint64(0))[:, None] for b in range(digits)]
        for s in range(drop, slices.shape[1]):
            y = slices[d, s][None, :] if flip is None else slices[d, s][None, :] ^ flip
            for b, take in enumerate(takes):
                put(s - drop + b, y & take)
    out, weight = [], 0
    while columns and weight <= max(columns):
        column = columns.get(weight, [])
        if len(column) == 2:
            total, carry = column[0] ^ column[1], column[0] & column[1]
            column = [total]
            put(weight + 1, carry)
        out.append(column[0] if column else np.zeros((len(queries), slices.shape[2]), dtype=np.uint64))
        weight += 1
    return out


def _count(bitmaps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)


def kth_value(sums: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Per query the k-th largest sum (the least, if there are fewer rows),
    found from the most significant slice downward. ``rows`` is the bitmap of
    all rows."""
    queries = len(sums[0]) if sums else 1
    value = np.zeros(queries, dtype=np.int64)
    wanted = np.full(queries, min(k, int(np.bitwise_count(rows).sum())), dtype=np.int64)
    tied = np.repeat(rows[None, :], queries, axis=0)
    for s in range(len(sums) - 1, -1, -1):
        ones = tied & sums[s]
        many = _count(ones)
        enough = many >= wanted
        value += enough.astype(np.int64) << s
        wanted -= np.where(enough, 0, many)
        tied = np.where(enough[:, None], ones, tied & ~sums[s])
    return value


def at_least(sums: list[np.ndarray], rows: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Bitmaps [query, word] of the rows whose sum is ``value`` or more."""
    above = np.zeros((len(value), len(rows)), dtype=np.uint64)
    equal = np.repeat(rows[None, :], len(value), axis=0)
    for s in range(len(sums) - 1, -1, -1):
        bit = np.where((value >> s) & 1 == 1, _ALL, np.uint64(0))[:, None]
        above |= equal & sums[s] & ~bit
        equal &= ~(sums[s] ^ bit)
    return above | equal


def boundary(queries: np.ndarray, slices: np.ndarray, n: int, k: int, keep: int = SLICES) -> np.ndarray:
    """Bitmaps [query, word] of the rows that can be among the best k of the
    ``n`` rows: those whose coarse sum is within the bound of the k-th best
    (all rows, where sums of huge components would leave 62 bits)."""
    drop = max(0, slices.shape[1] - keep)
    rows = np.full(slices.shape[2], _ALL, dtype=np.uint64)
    if n % 64:
        rows[-1] = np.uint64(2 ** (n % 64) - 1)
    largest = max(int(queries.max(initial=0)), -int(queries.min(initial=0)))
    sums = []
    if largest * max(1, queries.shape[1]) << slices.shape[1] < 2**62:
        sums = add_slices(queries, slices, drop)
    if not sums:
        return np.repeat(rows[None, :], len(queries), axis=0)
    # the digits left out of an attribute add at most |q| * (2**drop - 1), in units of 2**drop
    slack = (np.abs(queries).sum(axis=1) * (2**drop - 1)) >> drop
    return at_least(sums, rows, np.maximum(kth_value(sums, rows, k) - slack, 0))


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of one query with rows; beyond 64 bits they are
    held at the ends of the range."""
    span = [max(int(v.max(initial=0)), -int(v.min(initial=0))) for v in (q, x)]
    if span[0] * span[1] * max(1, len(q)) < 2**63:
        return x @ q
    wide = x.astype(object) @ q.astype(object)
    return np.array([max(1 - 2**63, min(2**63 - 1, int(s))) for s in wide], dtype=np.int64)


def build_index(rows: DataFrame, parts: int) -> DataFrame:
    """The index table: one row per part of the rows (by hash, within vectors
    of equal length) with the slices of its distinct vectors and the ids of
    each (``ends`` cuts ``ids`` into classes)."""

    def build(key, t):
        part, dim = key[0].as_py(), key[1].as_py()
        x = np.asarray(t.column("x").combine_chunks().flatten()).reshape(t.num_rows, dim)
        ids = t.column("vec_id").to_numpy()
        order = np.lexsort((ids, *x.T))
        x, ids = x[order], ids[order]
        first = np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)])
        starts = np.flatnonzero(first)
        low, width, words, slices = slice_attributes(x[starts])
        ends = np.append(starts[1:], len(ids))
        one = [[part], [dim], [len(starts)], [width], [words], [low.tolist()], [slices.tobytes()], [ids], [ends]]
        types = [pa.int32()] * 5 + [pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.table([pa.array(v, ty) for v, ty in zip(one, types)],
                        names=["part", "dim", "size", "width", "words", "low", "slices", "ids", "ends"])

    dealt = rows.select("vec_id", "x", F.size("x").alias("dim"),
                        F.pmod(F.xxhash64("vec_id", "x"), F.lit(parts)).cast("int").alias("part"))
    return dealt.groupBy("part", "dim").applyInArrow(build, _INDEX)


def _search_part(left: pa.Table, right: pa.Table, k: int, keep: int) -> pa.Table:
    """Best k + 1 rows of one part for each query vector."""
    found: list[list] = [[], [], [], []]
    if left.num_rows and right.num_rows:
        part = right.to_pylist()[0]
        dim, n = part["dim"], part["size"]
        low = np.array(part["low"], dtype=np.int64)
        slices = np.frombuffer(part["slices"], dtype=np.uint64).reshape(dim, part["width"], part["words"])
        ids, ends = np.array(part["ids"], dtype=np.int64), np.array(part["ends"])
        starts = np.concatenate([[0], ends[:-1]])
        names = left.column("query").to_pylist()
        q = np.asarray(left.column("q").combine_chunks().flatten()).reshape(left.num_rows, dim)
        step = max(1, PASS_WORDS // max(1, part["words"]))
        for i in range(0, len(q), step):
            some = q[i : i + step]
            bitmaps = boundary(some, slices, n, k + 1, keep)
            for j, bits in enumerate(bitmaps):
                rows = np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little")[:n])
                score = exact_scores(some[j], rebuild(low, slices, rows))
                # a class below k + 1 better rows gives none; of a class only its first k + 1 ids can
                best = np.argsort(-score, kind="stable")
                cut = score[best[min(k, len(best) - 1)]]
                rows, score = rows[score >= cut], score[score >= cut]
                take = np.minimum(ends[rows] - starts[rows], k + 1)
                which = np.repeat(np.arange(len(rows)), take)
                at = np.arange(len(which)) - np.repeat(np.cumsum(take) - take, take) + starts[rows][which]
                row_ids, row_scores = ids[at], score[which]
                first = np.lexsort((row_ids, -row_scores))[: k + 1]
                found[0] += [names[i + j]] * len(first)
                found[1].append(np.repeat(exact_scores(some[j], some[j : j + 1]), len(first)))
                found[2].append(row_ids[first])
                found[3].append(row_scores[first])
    return pa.table([pa.array(found[0], pa.string()), *[
        pa.array(np.concatenate(f) if f else np.array([], dtype=np.int64), pa.int64()) for f in found[1:]]],
        names=["query", "own", "vec_id", "score"])


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, keep: int = SLICES, part_rows: int = PART_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` largest integer inner products of every row whose vec_id is
    divisible by ``every`` with all other rows: query_id, rank, vec_id, score,
    ties to the smaller vec_id.

    Rows that repeat id and vector count once; an id with two vectors is two
    rows, each a query of its own and a candidate for the other. Empty and zero
    vectors take part (score 0); only vectors of equal length are compared; an
    empty table gives an empty result; other columns are ignored."""
    spark = vectors.sparkSession
    ready_workers(spark)
    rows = materialise(quantised(vectors), "quantised")
    total = rows.count()
    # small tables are dealt over the cores, large ones by the size of a part
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, -(-total // part_rows), min(2 * cores, -(-total // (part_rows // 16 or 1))))
    index = materialise(build_index(rows, parts), "slices")
    asked = rows.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0).withColumn(
        "query", F.sha2(F.concat_ws(",", F.col("x").cast("array<string>")), 256))
    asked = materialise(asked, "queries")
    distinct = asked.groupBy("query").agg(F.first("x").alias("q"))
    groups = max(1, -(-asked.count() // query_rows))
    piece = F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int")
    left = distinct.select("query", "q", F.size("q").alias("dim"), piece.alias("piece"),
                           F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    right = index.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        return _search_part(a, b, k, keep)

    cells = (left.groupBy("part", "dim", "piece").cogroup(right.groupBy("part", "dim", "piece"))
             .applyInArrow(search, "query string, own long, vec_id long, score long"))
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = cells.withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k + 1)
    lists = best.groupBy("query").agg(F.first("own").alias("own"), F.sort_array(
        F.collect_list(F.struct("n", "vec_id", "score"))).alias("found"))
    listed = asked.join(lists, "query").select(F.col("vec_id").alias("query_id"), "own", "found")
    # an entry with the query's id and the score of its vector with itself is its own row, or reads like it
    place = F.expr("array_position(transform(found, c -> c.vec_id = query_id and c.score = own), true)")
    others = F.expr(f"slice(filter(found, (c, i) -> place = 0 or i != place - 1), 1, {k})")
    return (listed.withColumn("place", place).select("query_id", F.posexplode(others).alias("at", "c"))
            .select("query_id", (F.col("at") + 1).alias("rank"), "c.vec_id", "c.score"))


#: The same in DuckDB SQL.
TOP_K_SQL = f"""WITH rows AS (
    SELECT DISTINCT vec_id, [CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
scored AS (
    SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.x::DOUBLE[], r.x::DOUBLE[]) AS BIGINT) AS score
    FROM rows q JOIN rows r ON q.vec_id % {EVERY} = 0 AND q.vec_id != r.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= {K}"""
