from __future__ import annotations

import random

import numpy as np
import pytest

from keepwise.llm import toxicity

from .conftest import sentence


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(900):
        words = sentence(rng, "en", rng.randint(10, 60)).split()
        toxic = i % 4 == 0
        for _ in range(rng.randint(1, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["blarg!", "Snork", "vex" + rng.choice(["ing", "ed", "er"])]))
        docs.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_unlabelled_documents_are_graded(labelled):
    docs, labels = labelled
    rows = toxicity.grade_documents(docs, labels).collect()
    assert len(rows) == 900
    new = [r for r in rows if r.doc_id % 2]
    assert not any(r.toxic for r in new)  # all odd ids are clean
    even = [r for r in rows if r.doc_id % 2 == 0]
    assert sum(r.toxic == (r.doc_id % 4 == 0) for r in even) / len(even) > 0.99
    assert all(0 <= r.severity <= 2 and r.grade in (0, 1, 2) for r in rows)


def test_filter_takes_effect(labelled):
    docs, labels = labelled
    kept = toxicity.keep_civil(docs, labels)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and {i for i in range(900) if i % 4} <= ids and len(ids) < 700


def test_cumulative_link_fit():
    """Recovers order and sign, and beats the constant model's likelihood."""
    rng = np.random.default_rng(0)
    x = (rng.random((3000, 4)) < 0.4).astype(float)
    z = x @ np.array([2.0, 1.0, 0.0, 3.0]) + rng.logistic(size=3000)
    grade = (z > 2).astype(int) + (z > 4)
    w, (t1, t2) = toxicity.fit_ordinal(x, grade)
    assert t1 < t2 and w[3] > w[0] > w[1] > w[2] >= 0
    assert abs(w[3] - 3) < 0.4 and abs(t1 - 2) < 0.3 and abs(t2 - 4) < 0.4


def test_more_hits_are_more_severe():
    model = toxicity.OrdinalModel({"blarg": 1.0, "vex-": 1.0, "*": 1.0}, (2.0, 4.0))
    values = [model.severity(t) for t in ("fine", "blarg", "blarg vexing", "blarg vexing vexer BLARG")]
    assert values == sorted(values) and len(set(values)) == 4
    assert model.hits("Vexing vex vexed, blarg") == {"vex-": 2, "blarg": 1, "*": 3}


def test_odd_cases(spark, labelled, odd_docs, no_docs):
    docs, labels = labelled
    assert toxicity.grade_documents(no_docs, labels).collect() == []
    rows = toxicity.grade_documents(odd_docs, labels.where("false")).collect()
    assert len(rows) == odd_docs.count() and all(r.severity == 0 and not r.toxic for r in rows)
    model = toxicity.fit(docs, labels)
    got = toxicity.predict(odd_docs, model, keep=odd_docs.columns, name="s")
    assert got.columns == [*odd_docs.columns, "s"] and got.where("s > 0.2").count() == 0
