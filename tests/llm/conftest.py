from __future__ import annotations

import random

import pytest

WORDS = {"en": "the of and house river with from this that water over stone light".split(),
         "de": "der und nicht das ist haus fluss mit von wasser über stein licht schön".split(),
         "fr": "le la et une maison rivière avec dans eau sur pierre lumière était".split()}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n)).capitalize() + "."


LONG = "word " * 30_000 + "x" * 100_000 + " 1" * 5_000
#: Texts that must not crash anything.
ODD = [None, "", " \n\t", "a", "é́ 中文 \U0001f600", LONG, "same text here", "same text here", "\x00\x85\xa0", "..."]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, a null and a repeated doc_id, and extra columns whose names
    the operators use themselves."""
    rows = [(i, t, None, 1, "r", 2.0) for i, t in enumerate(ODD)] + [
        (None, "no id", "en", None, None, None), (7, "same text here", None, 1, "r", 2.0), (50, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, block int, fingerprint string, score double")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
