"""Periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least
``MIN_LENGTH`` words and ``MIN_POWER`` * q words long, that no neighbouring
word extends with the same period. Periods are looked for at the dyadic
scales t = 4, 8, 16, ...; scale t is responsible for the periods t <= q < 2t:

* every window of t words gets a fingerprint; windows whose own period is at
  most t / 4 are left out. Position i is synchronising if the least (mixed)
  fingerprint of the windows i .. i + t is that of window i or of window i + t.
  The choice depends on the 2t words from i alone, so equal contexts choose
  alike, and every t neighbouring positions hold a chosen one unless the words
  there are highly periodic;
* two successive chosen positions with equal contexts of 2t words propose their
  distance as a period; the proposal is extended to both sides by comparing
  fingerprints of halving lengths. Inside a run of period q the next equal
  context is exactly q further (2t > q), so proposals have the smallest period,
  and a run of 4q words always holds such a pair;
* the regions left out are highly periodic, with periods up to t / 4: their runs
  were found at a smaller scale, those of periods 1 to 3, below the least scale,
  by comparing the words with themselves shifted.

Fingerprints are polynomial hashes to two prime moduli below 2**31 (62 bits).

Texts are read whole, a batch of documents at a time: documents are laid end to
end, longest first, with a symbol of its own after each, so every scale works on
the documents long enough for it. Memory is proportional to the words of a batch,
or of one document where that is longer.

Results for odd input: null and wordless texts have no words and no run; texts
may be of any length; repeated rows (and null doc_ids) give one result per row;
of runs of equal length the smaller start, then the smaller period comes first;
an empty table gives an empty result; extra columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import col, ready_workers

MIN_LENGTH = 6
MIN_POWER = 4
FIRST_SCALE = 4
#: Words laid end to end at once (a longer document stands alone).
CHUNK_WORDS = 1 << 19
#: Prime moduli and bases of the fingerprints.
_HASHES = ((2147483647, 1103515245), (2147483629, 1220703125))
_RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


class _Fingerprints:
    """Fingerprint of any stretch of ``words`` (distinct small integers)."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.n, self.sums, self.powers = n, [], []
        for p, base in _HASHES:
            power = np.ones(n + 1, dtype=np.int64)
            done, step = 1, base % p
            while done <= n:
                m = min(done, n + 1 - done)
                power[done : done + m] = power[:m] * step % p
                done, step = done + m, step * step % p
            # spread the ids first: neighbouring ids would otherwise cancel in short stretches
            symbol = (words.astype(np.int64) + 1) * 48271 % p
            self.powers.append(power)
            self.sums.append(np.concatenate([[0], np.cumsum(symbol * power[:n] % p)]))

    def of(self, at: np.ndarray, length) -> np.ndarray:
        """62-bit fingerprints of the ``length`` words from each ``at``."""
        out = np.zeros(len(at), dtype=np.int64)
        for (p, _), power, sums in zip(_HASHES, self.powers, self.sums):
            part = (sums[at + length] - sums[at]) % p * power[self.n - at] % p
            out = out << 31 | part
        return out

    def common(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """Length of the longest equal stretches that begin at a and b
        (forward) or end before them; a < b."""
        length = np.zeros(len(a), dtype=np.int64)
        room = self.n - b if forward else a
        step = 1 << max(0, int(self.n).bit_length() - 1)
        while step:
            at = np.flatnonzero(length + step <= room)
            if len(at):
                shift = length[at] if forward else -length[at] - step
                x, y = a[at] + shift, b[at] + shift
                length[at[self.of(x, step) == self.of(y, step)]] += step
            step >>= 1
        return length


def _mixed(x: np.ndarray) -> np.ndarray:
    """Fingerprints in an order unrelated to their values (never the largest)."""
    y = x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    y ^= y >> np.uint64(29)
    y *= np.uint64(0xBF58476D1CE4E5B9)
    return (y ^ (y >> np.uint64(32))) >> np.uint64(1)


_LEFT_OUT = np.uint64(2**64 - 1)


def synchronising(prints: _Fingerprints, n: int, scale: int, periodic: np.ndarray) -> np.ndarray:
    """Chosen positions among the first ``n`` words; ``periodic`` marks the
    positions whose window of ``scale`` words is left out."""
    count = n - scale + 1
    if count <= scale:
        return np.array([], dtype=np.int64)
    value = _mixed(prints.of(np.arange(count), scale))
    value[periodic[:count]] = _LEFT_OUT
    least, width = value.copy(), 1
    while width < scale:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[: count - scale], value[scale:])
    chosen = (least != _LEFT_OUT) & ((least == value[: count - scale]) | (least == value[scale:]))
    return np.flatnonzero(chosen)


def _shifted(words: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the stretches with period q, at least 4q long, by
    direct comparison; q = 1, 2, 3 (primes or 1), so a smaller period is 1."""
    same = np.concatenate([[False], words[:-q] == words[q:], [False]])
    edge = np.flatnonzero(same[1:] != same[:-1])
    start, length = edge[0::2], edge[1::2] - edge[0::2] + q
    good = length >= MIN_POWER * q
    start, length = start[good], length[good]
    if q > 1 and len(start):
        constant = words[start] == words[start + 1]
        for i in range(1, q - 1):
            constant &= words[start] == words[start + i + 1]
        start, length = start[~constant], length[~constant]
    return start, length


def find_runs(words: np.ndarray, longest: np.ndarray | None = None) -> np.ndarray:
    """All stretches of smallest period q at least 4q long, as rows (start,
    length, period). ``longest[t]`` is the number of leading words that belong
    to documents of at least t words (default: one document)."""
    found = []
    for q in range(1, FIRST_SCALE):
        if len(words) > q:
            start, length = _shifted(words, q)
            found.append(np.stack([start, length, np.full(len(start), q)], axis=1))
    prints, scale = None, FIRST_SCALE
    while True:
        need = MIN_POWER * scale
        n = len(words) if longest is None else int(longest[need]) if need < len(longest) else 0
        if n < need:
            break
        prints = prints or _Fingerprints(words)
        depth = np.zeros(n + 1, dtype=np.int64)
        for runs in found:
            small = runs[(runs[:, 2] * 4 <= scale) & (runs[:, 1] >= scale) & (runs[:, 0] + runs[:, 1] <= n)]
            np.add.at(depth, small[:, 0], 1)
            np.add.at(depth, small[:, 0] + small[:, 1] - scale + 1, -1)
        at = synchronising(prints, n, scale, np.cumsum(depth[:n]) > 0)
        at = at[at + 2 * scale <= n]
        context = prints.of(at, 2 * scale)
        order = np.argsort(context, kind="stable")
        a, b = at[order[:-1]], at[order[1:]]
        proposed = (context[order[:-1]] == context[order[1:]]) & (b - a >= scale) & (b - a < 2 * scale)
        a, b = a[proposed], b[proposed]
        back, ahead = prints.common(a, b, False), prints.common(a, b, True)
        runs = np.stack([a - back, back + ahead + (b - a), b - a], axis=1)
        found.append(np.unique(runs[runs[:, 1] >= MIN_POWER * runs[:, 2]], axis=0))
        scale *= 2
    return np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)


def runs_of(documents: list[list]) -> list[np.ndarray]:
    """Per document (a list of words) its runs, by start, then period."""
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    out: list = [None] * len(documents)
    at = 0
    while at < len(order):
        chunk, size = [], 0
        while at < len(order) and (not chunk or size + len(documents[order[at]]) <= CHUNK_WORDS):
            chunk.append(order[at])
            size += len(documents[order[at]]) + 1
            at += 1
        seen: dict = {}
        ids: list[int] = []
        for place, i in enumerate(chunk):
            ids += [seen.setdefault(w, len(seen) + len(chunk)) for w in documents[i]]
            ids.append(place)
        sizes = np.array([len(documents[i]) + 1 for i in chunk])
        ends = np.cumsum(sizes)
        # documents come longest first: those of at least t words are a prefix
        enough = np.searchsorted(-(sizes - 1), -np.arange(sizes[0] + 1), side="right")
        longest = np.concatenate([[0], ends])[enough]
        runs = find_runs(np.array(ids, dtype=np.int64), longest)
        runs = runs[runs[:, 1] >= MIN_LENGTH]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
        owner = np.searchsorted(ends, runs[:, 0], side="right")
        runs[:, 0] -= (ends - sizes)[owner]
        cut = np.searchsorted(owner, np.arange(len(chunk) + 1))
        for place, i in enumerate(chunk):
            out[i] = runs[cut[place] : cut[place + 1]]
    return out


def kept_words(words: list, runs: np.ndarray) -> list:
    """``words`` without those that a run repeats after its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def periodic_runs(docs: DataFrame, prepare: Callable[[int | None, list], list] | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, ``runs`` (array of start, length,
    period in words, by start, then period) and ``collapsed`` (the words kept
    when every run is reduced to its first period, joined by one space).
    Words are what stands between ASCII white space; ``prepare`` may change a
    document's words (bytes) first."""
    ready_workers(docs.sparkSession)
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_words", LongType()),
                         StructField("runs", ArrayType(_RUN)), StructField("collapsed", StringType())])

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            # without arguments bytes are split at ASCII white space, the words of the contract
            words = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column(1).to_pylist()]
            if prepare is not None:
                words = [prepare(i, w) for i, w in zip(ids, words)]
            runs = runs_of(words)
            flat = np.concatenate(runs) if runs else np.empty((0, 3), dtype=np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32())
            structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(w) for w in words], pa.int64()),
                pa.ListArray.from_arrays(offsets, structs),
                pa.array([b" ".join(kept_words(w, r)) for w, r in zip(words, runs)], pa.binary()).cast(pa.string())],
                names=schema.names)

    return docs.select(col("doc_id"), col("text")).mapInArrow(run, schema)


def digest_runs(found: DataFrame) -> DataFrame:
    """The figures of ``periodic_runs`` per row: number of runs, the longest
    run with its exponent in thousandths, digests of all runs and of the
    collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    out = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), longest.alias("x"),
                       F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").alias("listed"), "collapsed")
    length, period = F.col("x.length"), -F.col("x.less")
    return out.select(
        "doc_id", "n_runs", (-F.col("x.before")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("(1000 * x.length) div (-x.less)").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
