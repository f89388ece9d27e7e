from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from keepwise.llm import language
from keepwise.llm.common import table

from .conftest import WORDS, sentence


def grams(text):
    """Presence sets by plain Python: letters lower-cased, runs of others one space."""
    out, last = [], " "
    for ch in text:
        c = ch.lower()[0] if ch.isalpha() else " "
        if not (c == last == " "):
            out.append(c)
        last = c
    s = " " + "".join(out) + ("" if out and out[-1] == " " else " ")
    return [{s[i : i + n] for i in range(len(s) - n + 1)} for n in (1, 2, 3)]


def test_presence_matches_plain_sets():
    for text in ["Hello, World", "a", "Élan vital 12 x", "der  die\ndas"]:
        got, want = language.presence(text), grams(text)
        for g, w in zip(got, want):
            assert abs(len(g) - len(w)) <= 1  # at most a hash collision
    assert language.presence(None) is None and language.presence("12 !? ") is None


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, sentence(rng, lang, rng.randint(3, 40)), lang if i % 7 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy_and_contract(spark, corpus):
    truth = {i: ("en", "de", "fr")[i % 3] for i in range(600)}
    rows = language.identify(corpus).collect()
    assert len(rows) == 600
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_prediction_reads_only_the_text(spark, corpus):
    """A held-out row's own label, id or source changes nothing."""
    from pyspark.sql import functions as F

    base = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(corpus).collect()}
    changed = corpus.withColumn("lang", F.when(language.held_out(), F.lit("fr")).otherwise(F.col("lang")))
    assert {r.doc_id: (r.lang_pred, r.score) for r in language.identify(changed).collect()} == base


def test_folded_weights_equal_the_kernel_form():
    """The batched product gives sum over landmarks of alpha * kernel."""
    rng = np.random.default_rng(0)
    texts = [sentence(random.Random(i), lang, 12) for i, lang in enumerate(("en", "de", "fr", "en"))]
    found = [language.presence(t) for t in texts]
    alpha = rng.normal(size=(3, 2))
    marks = np.zeros((len(language.ORDERS) * language.BUCKETS, 3))
    for j in range(3):
        at, w = language._rows(found[j])
        marks[at, j] = w

    def kernel(x, z):
        return np.mean([len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b)) for a, b in zip(x, z)])

    want = np.array([[kernel(f, found[j]) for j in range(3)] for f in found]) @ alpha
    got = language.LanguageModel(["a", "b"], (marks @ alpha).astype(np.float32)).scores(found)
    assert np.allclose(got, want, atol=1e-4)


def test_odd_texts(spark, odd_docs, no_docs, corpus):
    both = corpus.select("doc_id", "text", "lang").unionByName(odd_docs.selectExpr("doc_id + 10000 AS doc_id", "text", "lang"))
    rows = {r.doc_id: r for r in language.identify(both).collect()}
    for i in (10000, 10001, 10002, 10008, 10009):  # null, empty, white space, no letter
        assert rows[i].lang_pred == "und" and rows[i].score == 0
    assert language.identify(no_docs).collect() == []
    assert [r.lang_pred for r in language.identify(odd_docs.where("doc_id = 3")).collect()] == ["und"]  # nothing learned


def test_filter_keeps_clean_documents(spark, corpus, odd_docs):
    assert language.keep_identified(corpus).count() == corpus.count()
    kept = language.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns
    assert None not in {r.text for r in kept.collect()}


def test_driver_tables(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.9
