"""Language identification by string kernels.

Kernel: blended spectrum of character n-grams, n = 1, 2, 3. A text is the set
of its n-grams (presence, not counts) after lower-casing and reading every run
of non-letters as one space; n-grams are hashed to ``BUCKETS`` per n. Two texts
score the mean over n of |common| / sqrt(|P_n(x)| |P_n(z)|).

Learning: landmarks are drawn from the training rows (Nystroem), and a kernel
ridge regression per language against the rest is solved on them. The kernel
is linear in the presence vectors, so landmarks and coefficients fold into
one weight table per n and a batch of texts is scored by one sparse
presence-by-weights matrix product.

Training uses at most ``TRAIN_ROWS`` rows (and ``PER_LANGUAGE`` a language),
chosen by a hash of doc_id: the documented bound of the classifier's sample.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StringType, StructField, StructType

from .common import annotate

ORDERS = (1, 2, 3)
BUCKETS = 1 << 13
TRAIN_ROWS = 1600
PER_LANGUAGE = 200
LANDMARKS = 160
RIDGE = 1e-3
UNKNOWN = "und"
#: Documents whose best language scores less are rejected by ``keep_identified``.
MIN_SCORE = 0.25

_MULTIPLIERS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> itself lower-cased if it is a letter, else a space."""
    table = np.full(sys.maxunicode + 1, 32, dtype=np.uint32)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(ch := chr(c))[0] == "L":
            low = ch.lower()
            table[c] = ord(low[0])
    return table


def presence(text: str | None) -> list[np.ndarray] | None:
    """Sorted bucket numbers per n-gram order; None if the text has no letter."""
    if not text:
        return None
    c = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    c = c[np.append(True, (c[1:] != 32) | (c[:-1] != 32))]
    if not (c != 32).any():
        return None
    c = np.concatenate([[32], c, [32]]).astype(np.uint32)
    found = []
    for n in ORDERS:
        h = np.zeros(len(c) - n + 1, dtype=np.uint32)
        for i in range(n):
            h = (h ^ c[i : len(c) - n + 1 + i]) * _MULTIPLIERS[i]
        mark = np.zeros(BUCKETS, dtype=bool)
        mark[h >> np.uint32(32 - 13)] = True
        found.append(np.flatnonzero(mark).astype(np.uint16))
    return found


def _rows(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers over all orders and their weights: the kernel is the
    inner product of these sparse vectors."""
    at = np.concatenate([f.astype(np.int64) + i * BUCKETS for i, f in enumerate(found)])
    weight = np.concatenate([np.full(len(f), 1 / np.sqrt(len(f) * len(ORDERS))) for f in found])
    return at, weight


def training_rows(docs: DataFrame, label: str = "lang") -> DataFrame:
    """Labelled rows whose crc32(doc_id as text) mod 3 is not 1."""
    return docs.where(F.col(label).isNotNull() & F.col("text").isNotNull() & ~held_out())


def held_out():
    """crc32(doc_id as text) mod 3 = 1; false for a null doc_id, which is not
    learned from either."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


class LanguageModel:
    """Languages in ascending order and the folded weights of each."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    def scores(self, found: list[list[np.ndarray]]) -> np.ndarray:
        """Regression value per text and language: a sparse matrix product."""
        pairs = [_rows(f) for f in found]
        at, value = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        starts = np.cumsum([0, *(len(p[0]) for p in pairs[:-1])])
        return np.add.reduceat(self.weights[at] * value[:, None].astype(np.float32), starts, axis=0)


def fit(docs: DataFrame, label: str = "lang", rows: int = TRAIN_ROWS, per_language: int = PER_LANGUAGE,
        landmarks: int = LANDMARKS) -> LanguageModel:
    """Fit on a bounded sample of the training rows of ``docs`` (doc_id, text,
    label). Without any training row the model knows no language."""
    known = training_rows(docs.select("doc_id", "text", F.col(label).cast("string").alias("lang"))).where(
        F.col("doc_id").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((len(ORDERS) * BUCKETS, 0), dtype=np.float32))
    each = max(1, min(per_language, rows // len(languages)))
    order = F.xxhash64("doc_id", F.lit("language sample"))
    # twice the wanted share by hash first, so that the exact cut ranks few rows
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, (2 * each + 50) / n)))])
    few = known.where(F.pmod(order, F.lit(1_000_000)) < F.element_at(share, F.col("lang")) * 1_000_000)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id")))

    def make():
        def compute(texts):
            found = [presence(t) for t in texts]
            packed = [None if f is None else np.concatenate([[len(x) for x in f], *f]).astype("<u2").tobytes()
                      for f in found]
            return [pa.array(packed, pa.binary())]

        return compute

    sample = annotate(ranked.where(F.col("rank") <= each), "text",
                      StructType([StructField("grams", BinaryType())]), make, ["lang", "rank"]).orderBy(
        "lang", "rank").where("grams is not null").collect()
    if not sample:
        return LanguageModel([], np.zeros((len(ORDERS) * BUCKETS, 0), dtype=np.float32))

    def unpack(data):
        x = np.frombuffer(data, dtype="<u2")
        return np.split(x[len(ORDERS) :], np.cumsum(x[: len(ORDERS)].astype(np.int64))[:-1])

    found = [unpack(r["grams"]) for r in sample]
    target = np.array([[1.0 if r["lang"] == lang else -1.0 for lang in languages] for r in sample])
    # landmarks: the first ranks of every language in turn
    chosen = sorted(range(len(sample)), key=lambda i: (sample[i]["rank"], sample[i]["lang"]))[:landmarks]
    marks = np.zeros((len(ORDERS) * BUCKETS, len(chosen)), dtype=np.float32)
    for j, i in enumerate(chosen):
        at, weight = _rows(found[i])
        marks[at, j] = weight
    kernel = np.array([weight @ marks[at] for at, weight in map(_rows, found)])
    inner = kernel[chosen]
    system = kernel.T @ kernel + RIDGE * len(sample) * inner + 1e-8 * np.eye(len(chosen))
    alpha = np.linalg.solve(system, kernel.T @ target)
    return LanguageModel(languages, (marks @ alpha).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, keep=("doc_id",), text: str = "text",
            names=("lang_pred", "score")) -> DataFrame:
    """``keep`` columns, the language and its score in [0, 1] ((value + 1) / 2
    of the regression, clipped; ties go to the first language by name). Null
    and letterless texts are ``und`` with score 0."""

    def make():
        def compute(texts):
            found = [presence(t) for t in texts]
            name, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            some = [i for i, f in enumerate(found) if f is not None]
            if some and model.languages:
                values = model.scores([found[i] for i in some])
                best = values.argmax(axis=1)
                for i, b, v in zip(some, best, values.max(axis=1)):
                    name[i], score[i] = model.languages[b], min(1.0, max(0.0, (float(v) + 1) / 2))
            return [pa.array(name, pa.string()), pa.array(score)]

        return compute

    fields = StructType([StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    return annotate(docs, text, fields, make, keep)


def identify(docs: DataFrame, label: str = "lang") -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. The model is learned
    from rows that are not held out; label, source and doc_id never reach a
    prediction. Repeated rows stay repeated; texts of any length are read whole;
    other columns are not read; an empty table gives none."""
    model = fit(docs, label)
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, label: str = "lang", min_score: float = MIN_SCORE) -> DataFrame:
    """Rows whose language is recognised: neither ``und`` nor scored under
    ``min_score``. Where nothing can be learned, every text with a letter stays."""
    model = fit(docs, label)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = ("keepwise_language", "keepwise_language_score")
    marked = predict(docs, model, docs.columns, names=names)
    return marked.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= min_score)).drop(*names)
