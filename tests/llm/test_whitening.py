from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from keepwise.llm import whitening


def grown(x):
    it = whitening.Spectrum(x[0].astype(float))
    for v in x.astype(float):
        it.add(v)
    return it


def close_to_scatter(it, x):
    c = x - x.mean(axis=0)
    want = c.T @ c
    top = max(np.linalg.eigvalsh(want)[-1], 1e-300)
    assert np.abs(it.u @ np.diag(it.s) @ it.u.T - want).max() <= 1e-11 * top
    assert np.abs(it.u.T @ it.u - np.eye(len(it.s))).max() <= 1e-12 and it.n == len(x)


def test_rank_one_updates_follow_the_scatter_matrix():
    """Random, constant, dependent and repeated entries: updates with and without deflation."""
    rng = np.random.default_rng(0)
    for t in range(60):
        d, n, m = int(rng.integers(1, 12)), int(rng.integers(1, 60)), int(rng.choice([1, 2, 50, 5000]))
        x = rng.integers(-m, m + 1, (n, d))
        if t % 3 == 0:
            x[:, d // 2] = 3
        if t % 5 == 0:
            x = x[:, :1] * np.ones((1, d), dtype=int)
        close_to_scatter(grown(x), x)


def test_merged_spectra_follow_the_scatter_matrix():
    rng = np.random.default_rng(1)
    x = rng.integers(-300, 300, (400, 20))
    it = grown(x[:100])
    for part in (x[100:101], x[101:350], x[350:]):
        it.merge(grown(part))
    close_to_scatter(it, x)


def test_secular_roots():
    rng = np.random.default_rng(4)
    for _ in range(50):
        m = int(rng.integers(1, 30))
        s, w = np.sort(rng.random(m)) * 10.0 ** rng.integers(-3, 6), rng.random(m) * 10.0 ** rng.integers(-8, 4) + 1e-12
        origin, offset = whitening.secular_roots(s, w)
        want = np.linalg.eigvalsh(np.diag(s) + np.sqrt(np.outer(w, w)))
        assert np.allclose(s[origin] + offset, want, rtol=0, atol=1e-13 * want[-1] * m)


def check(df, rows, k=4):
    got = defaultdict(list)
    for r in whitening.whiten(df, **({} if k == 4 else {"k": k})).collect():
        got[r.vec_id].append(r)
    x = np.array([np.floor(256 * np.array(v)) for _, v in rows]).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    trace = (c * c).sum() / n
    want = (x - s / n) @ vectors / np.sqrt(values)
    first = sorted(got[rows[0][0]], key=lambda r: r.component)
    assert [r.component for r in first] == list(range(1, len(first) + 1))
    by = {i: np.array([r.whitened for r in sorted(v, key=lambda r: r.component)]) for i, v in got.items()}
    mine = np.array([by[i] for i, _ in rows])
    sign = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine * sign - want).max() < 1e-8
    for (i, _), v in zip(rows, x):
        for r in got[i]:
            assert r.n == n and r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s))
            assert r.identity_error < 1e-9 and abs(r.explained / (values[r.component - 1] / trace) - 1) < 1e-9


def test_against_full_eigendecomposition(spark):
    """Driver table, a hot vector and rows that take no part; several partitions and a merge tree."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    rows += [(10_000 + i, rows[3][1]) for i in range(200)]
    odd = [(20_000, None), (20_001, [float("nan")] * 64), (20_002, [None] * 64), (20_003, [float("inf")] * 64), (20_004, [])]
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in rows + odd],
                               "vec_id long, embedding array<double>, n int, component string").repartition(7)
    check(df, rows)
    assert whitening.whiten(df.where("false")).collect() == [] and whitening.whiten(df.where("vec_id > 10000")).collect() == []


def test_refinement_repairs_a_poor_start(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 12)) * np.linspace(3, 1, 12)
    q = np.floor(256 * x).astype(np.int64)
    fit = spark.createDataFrame([(v.tolist(),) for v in q], "x array<long>").repartition(3)
    mean = q.mean(axis=0)
    off = whitening.Spectrum(mean, len(q), np.ones(12), np.linalg.qr(rng.normal(size=(12, 12)))[0])
    values, _, _ = whitening.refined(fit, off, mean, 2, guard=2)
    want = np.linalg.eigvalsh((q - mean).T @ (q - mean) / len(q))[::-1][:2]
    assert np.allclose(values, want, rtol=1e-9)


def test_few_directions_and_other_lengths(spark):
    """Only components with spread have rows; every vector length is fitted for itself; huge values give a null deviation."""
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(40)] + [(100, [1.0]), (101, [2.0]), (102, [2.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.component, r.n) for r in got if r.vec_id < 100} == {(1, 40)} and len(got) == 43
    assert {(r.vec_id, r.n, round(abs(r.whitened), 9)) for r in got if r.vec_id >= 100} == {(100, 2, 1.0), (101, 2, 1.0), (102, 2, 1.0)}
    assert all(r.explained == pytest.approx(1) for r in got)
    huge = whitening.whiten(spark.createDataFrame([(1, [1e9]), (2, [-1e9]), (3, [0.0])], "vec_id long, embedding array<double>"))
    assert {r.vec_id: r.deviation for r in huge.collect()} == {1: None, 2: None, 3: 0}
