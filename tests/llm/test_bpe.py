from __future__ import annotations

import hashlib
import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from keepwise.llm import bpe

from .conftest import sentence

WORD_BPE = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORD_BPE)


def check(got, docs, tokenizer):
    want = []
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_round_trip_equals_the_tokenizer(spark, tokenizer):
    rng = random.Random(5)
    parts = ["The", "HOUSE", " ", "  ", "\n", "\t", "\x0b", "\x85", "\xa0", "\x1c", "é", "é", "́", "İ", "ß", "Σ", "中文",
             "½", "12", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "​", "　", "\U0001f600", "!?", "_", "\x00"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))) for i in range(1500)]
    docs += [(5000 + i, sentence(rng, "de", 50)) for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for size in (2_000, 12_000_000):
        check(bpe.encode_documents(df, WORD_BPE, block_bytes=size).collect(), docs, tokenizer)


def test_odd_documents(odd_docs, no_docs, tokenizer):
    check(bpe.encode_documents(odd_docs, WORD_BPE).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()], tokenizer)
    assert bpe.encode_documents(no_docs, WORD_BPE).collect() == []


def test_decode_joins_pieces(spark, odd_docs, tokenizer):
    encoded = bpe.encode_documents(odd_docs.where("length(text) < 100 OR text IS NULL"), WORD_BPE, keep_ids=True)
    rows = encoded.collect()
    got = sorted((str(r.doc_id), r.decoded) for r in bpe.decode(encoded, WORD_BPE).collect())
    assert got == sorted((str(r.doc_id), tokenizer.decode(r.ids, skip_special_tokens=False)) for r in rows)
    assert got == sorted((str(r.doc_id), r.decoded) for r in rows)
    none = spark.createDataFrame([(1, None), (1, []), (1, [])], "doc_id long, ids array<long>")
    assert sorted(bpe.decode(none, WORD_BPE).collect(), key=str) == [(1, ""), (1, ""), (1, None)]


def test_each_distinct_word_is_in_one_bucket():
    words = {f"w{i}".encode() for i in range(500)}
    listed = bpe.bucketed(words, 7)
    assert sorted(w for ws in listed.values() for w in ws) == sorted(words)
    assert all(ws == sorted(ws) for ws in listed.values())
    parts = [b"", b"ab", b"cd" * 70_000, b"", b"ef" * 3]
    assert bpe._unpacked(bpe._packed(parts, 2), 5, 2) == parts and bpe._unpacked(bpe._packed([], 2), 0, 2) == []
