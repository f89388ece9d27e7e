from __future__ import annotations

import random

import numpy as np
import xxhash

from keepwise.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(rows):
    """rows (doc_id, fingerprint) -> component of each fingerprint."""
    codes = sorted({f for _, f in rows})
    parent = {c: c for c in codes}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[root(b)] = root(a)
    return {c: min((i for i, f in rows if i is not None and root(f) == root(c)), default=None) for c in codes}


def test_fingerprint_bits():
    for text in ["", " ", "One", "one two", "A b c d e f g", "x " * 500, "É b c"]:
        assert simhash.simhash64(text) == brute_fingerprint(text)
    assert simhash.simhash64("A B c") == simhash.simhash64("a b\tC") == xxhash.xxh64_intdigest(b"a b c", 42)


def test_long_texts_are_chunked(monkeypatch):
    text = " ".join(str(i) for i in range(1000))
    whole = simhash.simhash64(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.simhash64(text) == whole == brute_fingerprint(text)


def test_pairs_against_brute_force(spark):
    rng = random.Random(5)
    codes = {0, (1 << 64) - 1, 1 << 63, 0xF}
    while len(codes) < 600:
        base = rng.choice(sorted(codes)) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 3)):
            base ^= 1 << rng.randrange(64)
        codes.add(base)
    signed = {c - (1 << 64) if c >> 63 else c for c in codes}
    df = spark.createDataFrame([(c,) for c in sorted(signed)], "fp long")
    for d in (0, 1, 2):
        got = {tuple(r) for r in simhash.near_pairs(df, d).collect()}
        want = {(a, b) for a in signed for b in signed
                if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= d}
        assert got == want


def test_segment_counts(spark):
    rng = np.random.default_rng(1)
    codes = [0, -1, 1 << 62, -(1 << 63), *rng.integers(-(1 << 63), (1 << 63) - 1, 50).tolist()]
    df = spark.createDataFrame([(int(c),) for c in codes], "fp long")
    for r in df.select("fp", simhash.segment_counts(df.fp).alias("p")).collect():
        unsigned = r.fp & ((1 << 64) - 1)
        want = sum((unsigned >> s & 15).bit_count() << s for s in range(0, 64, 4))
        assert r.p == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(-5, 39)]
    got = {r.node: r.root for r in simhash.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: -5 for i in range(41)}, -5: -5, **{100 + i: 100 for i in range(60)}}
    assert simhash.connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_whole_operator_against_brute_force(spark, odd_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in odd_docs.select("doc_id", "text").collect()]
    comp = brute_components(rows)
    want = sorted(((i, f"{f:016x}", comp[f]) for i, f in rows), key=str)
    assert sorted(map(tuple, got), key=str) == want


def test_keep_one(spark, odd_docs, no_docs):
    kept = simhash.keep_one(odd_docs).select("doc_id", "text").collect()
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in odd_docs.collect()]
    comp = brute_components(rows)
    want = {i for i, f in rows if i is not None and comp[f] == i}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(want)
    assert simhash.keep_one(odd_docs).columns == odd_docs.columns
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.keep_one(no_docs).collect() == []


def test_hot_group_of_copies(spark):
    rows = [(i, "one two three four") for i in range(3000)] + [(5000 + i, f"other text number {i}") for i in range(20)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id < 3000")
    assert got.count() == 3000 and {r.component_id for r in got.select("component_id").distinct().collect()} == {0}


def test_keep_one_loses_no_unlike_text_of_a_repeated_id(spark):
    """One id with two unlike texts stands for two groups; near copies under one id and repeated rows leave one row."""
    a, b = "alpha beta gamma delta epsilon", "one two three four five six"
    rows = [(5, a, 1), (5, b, 2), (5, a, 1), (9, a, 3), (2, b, 4), (8, "seven eight nine ten", 5), (8, "seven eight nine ten", 5)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, t long").repartition(3))
    assert sorted(map(tuple, kept.collect())) == [(2, b, 4), (5, a, 1), (8, "seven eight nine ten", 5)]
    rows = [(5, a, 1), (5, b, 2), (6, a, 1)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, t long"))
    assert sorted(map(tuple, kept.collect())) == [(5, a, 1), (5, b, 2)]


def test_no_join_of_fingerprints_is_a_broadcast(spark):
    """Cells are 33 times their fingerprints, which Spark does not see: a small estimate must not make them a broadcast."""
    docs = spark.createDataFrame([(i, f"text number {i // 2} of many") for i in range(20)], "doc_id long, text string")
    fps = spark.createDataFrame([(i,) for i in range(20)], "fp long")
    edges = spark.createDataFrame([(1, 2), (2, 3)], "u long, v long")
    for made in (simhash.near_pairs(fps), simhash.components(fps.select(fps.fp.alias("doc_id"), "fp")), simhash.keep_one(docs)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(map(tuple, simhash.connected_components(edges).collect())) == [(1, 1), (2, 1), (3, 1)]
