from __future__ import annotations

import hashlib
import random

import numpy as np

from keepwise.llm import sketch

from .conftest import sentence


def brute(rows, size=sketch.SHINGLE):
    """rows (doc_id, text) in order; the contract read literally."""
    out = []
    texts = [t or "" for _, t in rows]
    for i, (doc_id, _) in enumerate(rows):
        text, following = texts[i], texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        s = [sketch.sketch(sketch.hashes(sketch.code_points(t))) for t in (text, edited, following)]

        def near(a, b, same):
            return len(set(a.tolist()) & set(b.tolist())) / min(len(a), len(b)) if len(a) and len(b) else float(same)

        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), sketch.encode(s[0]), sketch.encode(s[1]),
                    near(s[0], s[1], edited == text), near(s[0], s[2], text == following)))
    return out


def test_hashes_depend_on_the_shingle_alone():
    points = sketch.code_points("abcdefghijklmnopqrstuvwxyzé\U0001f600")
    all_at = sketch.hashes(points)
    assert len(all_at) == len(points) - sketch.SHINGLE + 1
    for i, h in enumerate(all_at):
        assert h == sketch.hashes(points[i : i + sketch.SHINGLE])[0]
    assert len(set(all_at.tolist())) == len(all_at) and len(sketch.hashes(points[:3])) == 1 and not len(sketch.hashes(points[:0]))
    assert int(all_at.max()) < 1 << sketch.HASH_BITS


def test_containment_estimates_between_unequal_texts():
    rng = random.Random(1)
    long = " ".join("".join(rng.choices("abcdefghij", k=7)) for _ in range(6000))
    a, b = sketch._Text(long).sketch, sketch._Text(long[:6000]).sketch
    assert sketch.containment(b, a) > 0.99 and abs(sketch.containment(a, b) - 6000 / len(long)) < 0.03
    parts = sketch.merge(sketch._Text(long[:20000]).sketch, sketch._Text(long[20000 - sketch.SHINGLE + 1 :]).sketch)
    assert np.array_equal(parts, a)


def test_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(10**12), sentence(rng, "fr", rng.randint(1, 200)) if rng.random() < 0.9 else rng.choice(["", "é", None]))
            for _ in range(400)]
    rows = sorted({i: t for i, t in rows}.items())
    rows += [(10**13 + i, "copy of the same long enough text") for i in range(40)]
    df = spark.createDataFrame(random.Random(0).sample(rows, len(rows)), "doc_id long, text string").repartition(7)
    for size in (10, 60, 2000):
        got = sorted(tuple(r) for r in sketch.fingerprint_documents(df, range_rows=size).collect())
        assert got == brute(rows)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = sorted(((r.doc_id, r.text or "") for r in odd_docs.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for size in (2, 2000):
        got = sketch.fingerprint_documents(odd_docs, range_rows=size).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))
    assert sketch.fingerprint_documents(no_docs).collect() == []
    alone = sketch.fingerprint_documents(odd_docs.where("doc_id = 3")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert sketch.fingerprint_documents(odd_docs.where("doc_id is null")).count() == 1
