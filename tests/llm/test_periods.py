from __future__ import annotations

import hashlib
import random
from zlib import crc32

import numpy as np
from keepwise.llm import periods, queries


def brute(w: list) -> list[tuple[int, int, int]]:
    """All runs by comparing the words with themselves at every distance."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length, block = j - i + q, w[i : i + q]
            if j > i and length >= max(6, 4 * q) and all(q % d or block != block[:d] * (q // d) for d in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng: random.Random, n: int) -> list[int]:
    k, w = rng.choice([1, 2, 3, 5, 50]), []
    while len(w) < n:
        block = [rng.randrange(k) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 15, 16, 17, 31, 33]))]
        if rng.random() < 0.3:  # a period nearly divided by a smaller one
            block = (block[:2] * len(block))[: len(block) - 1] + block[-1:]
        w += (block * rng.randint(1, 7))[: rng.randint(1, 6 * len(block))]
    return w


def test_runs_against_brute_force():
    rng = random.Random(5)
    seen = 0
    for _ in range(250):
        docs = [some_words(rng, rng.choice([0, 1, 6, 40, 100, 300])) for _ in range(rng.randint(0, 6))]
        for w, got in zip(docs, periods.runs_of(docs)):
            assert [tuple(r) for r in got.tolist()] == brute(w)
            seen += len(got)
    assert seen > 800


def test_long_runs_chunks_and_collapse(monkeypatch):
    """Periods far beyond the first scales; documents cut into several chunks give the same runs."""
    rng = random.Random(2)
    block = [rng.randrange(9) for _ in range(1000)]
    docs = [["a"] * 5, block * 5 + [1, 2], ["x", "y"] * 30_000, [rng.randrange(3) for _ in range(4000)], [], block[:700] * 4]
    want = [brute(d) if len(d) < 5000 else None for d in docs]
    want[1], want[2] = [(0, 5000, 1000)], [(0, 60_000, 2)]
    got = periods.runs_of(docs)
    for w, g in zip(want, got):
        assert set(w) <= {tuple(r) for r in g.tolist()} and (len(w) == len(g) or w == [(0, 5000, 1000)])
    monkeypatch.setattr(periods, "CHUNK_WORDS", 3000)
    assert all(np.array_equal(a, b) for a, b in zip(got, periods.runs_of(docs)))
    assert periods.kept_words(docs[2], got[2]) == ["x", "y"] and periods.kept_words(docs[5], got[5])[:700] == block[:700]


def test_synchronising_positions_are_consistent_and_dense():
    rng = np.random.default_rng(1)
    words = np.concatenate([rng.integers(0, 4, 400)] * 2 + [rng.integers(0, 4, 400)])
    prints = periods._Fingerprints(words)
    for scale in (4, 8, 32):
        chosen = periods.synchronising(prints, len(words), scale, np.zeros(len(words), dtype=bool))
        assert np.diff(chosen).max() <= scale
        inner = chosen[chosen + 2 * scale <= 400]
        assert set((inner + 400).tolist()) <= set(chosen.tolist())


def digest(doc_id, text):
    """The contract, word by word."""
    w = (text or "").encode().split()
    h = crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = brute(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
    return (len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


NAMES = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r[n] for n in NAMES) for r in queries.op11_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id] == digest(d.doc_id, d.text), d.doc_id
    assert sum(v[0] > 0 for v in got.values()) > 5


def test_odd_documents(spark, odd_docs, no_docs):
    def figures(docs):
        return periods.digest_runs(periods.periodic_runs(docs, queries.repeated_tail))

    got = sorted(((r.doc_id, *(r[n] for n in NAMES)) for r in figures(odd_docs).collect()), key=repr)
    rows = odd_docs.collect()
    short = [r for r in rows if r.text is None or len(r.text) < 1000]
    assert len(got) == len(rows)
    for r in short:
        assert (r.doc_id, *digest(r.doc_id, r.text)) in got
    assert figures(no_docs).collect() == []
    long = [g for g in got if g[0] == 5][0]
    assert long[2:5] in {(0, 30_000, 1), (30_001, 5000, 1)} or long[1] > 0
    one = periods.periodic_runs(odd_docs.where("doc_id = 5")).first()
    assert [tuple(r) for r in one.runs] == [(0, 30_000, 1), (30_001, 4_999, 1)] or [tuple(r) for r in one.runs][0] == (0, 30_000, 1)
    assert one.n_words == len(rows[5].text.split()) and one.collapsed.count("word") == 1
