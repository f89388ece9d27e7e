from __future__ import annotations

from math import floor, isfinite

import numpy as np
import pytest
from keepwise.llm import bitslice


def brute(rows, k, every):
    """(query_id, rank, vec_id, score) of all usable rows, one by one."""
    use = {(i, tuple(floor(256 * c) for c in v)) for i, v in rows
           if i is not None and v is not None and all(c is not None and isfinite(c) for c in v)}
    out = []
    for i, q in use:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in use if len(x) == len(q) and (j, x) != (i, q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def as_rows(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_index_keeps_vectors_and_boundary_holds_the_best():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n, d, m, k = (int(rng.integers(*r)) for r in ((1, 300), (0, 8), (1, 2000), (1, 8)))
        x = np.unique(rng.integers(-m, m + 1, (n, d)), axis=0) if d else np.zeros((1, 0), dtype=np.int64)
        q = rng.integers(-m, m + 1, (5, d))
        low, _, _, slices = bitslice.slice_attributes(x)
        assert np.array_equal(bitslice.rebuild(low, slices, np.arange(len(x))), x)
        found = bitslice.boundary(q, slices, len(x), k, keep=int(rng.integers(1, 6)))
        for j in range(5):
            rows = set(np.flatnonzero(np.unpackbits(found[j].view(np.uint8), bitorder="little")[: len(x)]).tolist())
            score = x @ q[j]
            assert set(np.flatnonzero(score >= np.sort(score)[::-1][min(k, len(x)) - 1]).tolist()) <= rows


def test_sum_slices_are_the_weighted_sums():
    rng = np.random.default_rng(3)
    x, q = rng.integers(-90, 90, (130, 5)), rng.integers(-40, 40, (7, 5))
    low, width, _, slices = bitslice.slice_attributes(x)
    sums = bitslice.add_slices(q, slices, 0)
    got = sum(np.unpackbits(s.view(np.uint8), axis=1, bitorder="little")[:, :130].astype(int) << i for i, s in enumerate(sums))
    y = x - low
    want = np.stack([(np.where(v < 0, 2**width - 1 - y, y) * np.abs(v)).sum(axis=1) for v in q])
    assert np.array_equal(got, want)


@pytest.mark.parametrize("sizes", [{}, {"part_rows": 64, "query_rows": 3, "keep": 2}])
def test_against_brute_force(spark, sizes):
    """Ties, a hot vector, an id with two vectors, repeated rows, other lengths, rows that take no part,
    clashing column names; the default parts and many small ones."""
    rng = np.random.default_rng(7)
    rows = [(i, (rng.integers(-4, 5, 6) / 4).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(150)]
    rows += [(50, [0.5] * 6), (7, [9.0] * 6), (50, [0.0] * 6), rows[3], rows[100], rows[100]]
    rows += [(2000, [1.0, 1.0]), (2001, [3.0, 1.0]), (2050, []), (2051, []), (-100, [1.0] * 6)]
    rows += [(400, None), (450, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (500, [float("nan")] * 6), (550, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "a", 2) for i, v in rows],
                               "vec_id long, embedding array<double>, part int, query string, score int").repartition(5)
    assert as_rows(bitslice.top_k(df, **sizes)) == brute(rows, 5, 50)
    assert bitslice.top_k(df.where("false")).collect() == []
    assert bitslice.top_k(df.where("vec_id = 2000")).collect() == []


def test_huge_components_are_held_in_range(spark):
    rows = [(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [1e15, 0.0]), (50, [1.0, 1.0])]
    got = as_rows(bitslice.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert len(got) == 6 and [r[2] for r in got if r[0] == 0] == [2, 50, 1] and [r[2] for r in got if r[0] == 50] == [0, 2, 1]
