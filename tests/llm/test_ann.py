from __future__ import annotations

import itertools
import math

import numpy as np

from keepwise.llm import ann


def brute(rows, k, every):
    """rows (vec_id, vector) that take part -> {query_id: [(vec_id, score)]}."""
    out = {}
    for i, q in rows:
        if i % every == 0:
            near = sorted(((-math.fsum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i and len(v) == len(q)))
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def as_lists(rows):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def test_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((1, 4), (2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        order = np.argsort(ann.hilbert_keys(cells, bits))
        assert sorted(ann.hilbert_keys(cells, bits)) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_small_tables_are_exact_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    good = [(int(i), rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(300)]
    good = [(i, v) for i, v in good if any(v)]
    good += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(120)]  # a hot vector
    good += [(2000, [1.0, 1.0]), (2001, [3.0, 1.0]), (2002, [-1.0, 0.0])]  # another length
    odd = [(400, None), (420, []), (440, [0.0] * 6), (460, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
           (480, [float("nan")] * 6), (500, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), good[0]]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in good + odd],
                               "vec_id long, embedding array<double>, class_id int, v string").repartition(5)
    got, want = as_lists(ann.search(df, k=20).collect()), brute(good, 20, 20)
    assert got.keys() == want.keys() and 400 not in got and 440 not in got
    for q in want:
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)
    assert ann.search(df.where("false")).collect() == []
    assert ann.search(df.where("vec_id = 2000")).collect() == []


def test_recall_of_narrow_windows(spark):
    """Windows that cut most rows off still find the neighbours of clustered vectors, over many blocks."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 4000)] + 0.3 * rng.normal(size=(4000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    got = as_lists(ann.search(df, min_window=100, window_share=0.03, block_rows=64).collect())
    x = x.astype("f4").astype(float)
    hits = total = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -9
        best = set(np.argsort(-s, kind="stable")[:20].tolist())
        hits, total = hits + len(best & {j for j, _ in found}), total + 20
    assert len(got) == 200 and hits / total >= 0.9


def test_recall_on_the_driver_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    x, ids = np.array([r.embedding for r in rows], dtype=float), np.array([r.vec_id for r in rows])
    got = as_lists(ann.search(df, min_window=300).collect())
    hits = 0
    for n in np.flatnonzero(ids % 20 == 0):
        s = x @ x[n]
        s[n] = -9
        hits += len(set(ids[np.argsort(-s)[:20]].tolist()) & {j for j, _ in got[ids[n]]})
    assert hits / (20 * (ids % 20 == 0).sum()) >= 0.9


def test_an_id_with_two_vectors_is_two_rows(spark):
    rows = [(20, [1.0, 0.0]), (7, [3.0, 0.0]), (7, [0.0, 5.0]), (3, [2.0, 1.0]), (5, [-1.0, 1.0])]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(7, 3.0), (3, 2.0), (7, 0.0), (5, -1.0)]
