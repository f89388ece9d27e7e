from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from keepwise.llm import packing

BPE, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(BPE)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def check(rows, docs, reference, capacity):
    """Every document whole, every sequence gapless and within the capacity."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for doc_id, text in docs:
        ids = np.array([*reference(text), 2], dtype="<u4")
        first = len(ids) % capacity or min(len(ids), capacity)
        starts = [0, *range(first, len(ids), capacity)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want.append((doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    return len(by_sequence)


def test_ids_equal_the_tokenizer(reference):
    rng = random.Random(3)
    parts = ["a", "the", " ", "  ", "\n", "\r\n", "\x85", "\xa0", "é", "中", "٣", "²", "'s", "'ll", "<|endoftext|>",
             "​", "　", "😀", "1", "23", "!", "\t", "Ꞑ", "́", "\x1c"]
    encode = packing.text_ids(BPE, RANKS)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert encode(text).tolist() == reference(text), text


def test_whole_operator(odd_docs, no_docs, reference):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for capacity, group in ((1024, 25_000), (16, 500)):
        rows = packing.pack_documents(odd_docs, BPE, RANKS, capacity, group_pieces=group).collect()
        check(rows, docs, reference, capacity)
    assert packing.pack_documents(no_docs, BPE, RANKS).collect() == []


def test_sum_of_squares_rule():
    """Each step against all gaps tried one by one."""
    rng = random.Random(8)
    sizes = sorted((rng.randint(1, 12) for _ in range(300)), reverse=True)
    number, offset = packing.sum_of_squares(sizes, 12)
    fill, n = {}, [0] * 13
    for size, seq, at in zip(sizes, number.tolist(), offset.tolist()):
        def after(g):
            m = n.copy()
            if g < 12:
                m[g] -= 1
            if g - size:
                m[g - size] += 1
            return sum(x * x for x in m)

        options = [g for g in range(size, 12) if n[g]]
        gap = 12 - fill.get(seq, 0)
        assert at == 12 - gap
        if size < 12 and options:
            assert gap < 12 and after(gap) == min(map(after, options))
        else:
            assert seq not in fill
        n = [x - (i == gap and gap < 12) + (i == gap - size and i > 0) for i, x in enumerate(n)]
        fill[seq] = fill.get(seq, 0) + size


def test_few_sequences(spark, reference):
    rng = random.Random(2)
    docs = [(i, " ".join(["word"] * rng.randint(1, 1500))) for i in range(800)]
    rows = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), BPE, RANKS).collect()
    used = check(rows, docs, reference, 1024)
    assert used <= 1.01 * -(-sum(r.length for r in rows) // 1024) + 1
