"""Toxicity grades by cumulative-link ordinal regression.

Grades: 0 clean, 1 toxic, 2 severely toxic. ``labels.toxic`` says whether a
document is toxic; among toxic training documents the grade is 2 where the
share of indicator terms in the text is above their median. Features are
sparse: the words of a text (runs of letters, lower-cased), their first three
to eight letters, which catch inflected and compounded forms, and the logarithm of
the number of all known words. One weight vector, not negative, is shared by
both ordered thresholds,

    P(grade <= k) = sigmoid(threshold_k - w . x),

and the result is the expected severity P(grade >= 1) + P(grade >= 2).

Fitting uses a bounded sample of labelled rows (``TOXIC_ROWS`` and
``CLEAN_ROWS``, chosen by a hash of doc_id) and at most ``MAX_FEATURES``
features: both are parameters of the classifier. Scoring reads every text whole.
"""

from __future__ import annotations

import re
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .common import annotate

TOXIC_ROWS = 2500
CLEAN_ROWS = 7500
MAX_FEATURES = 2000
#: Share of the toxic sample (and rows) a feature must occur in, and how many times likelier it must be there.
MIN_TOXIC_SHARE = 0.004
MIN_TOXIC_ROWS = 3
MIN_LIFT = 60.0
PREFIXES = range(3, 9)
#: The feature that counts all known words.
ANY = "*"
L2 = 2e-5
#: Documents of at least this expected severity (0 to 2) are rejected.
REJECT_SEVERITY = 0.2

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """The word and its prefixes, marked by a trailing hyphen."""
    return [word] + [word[:n] + "-" for n in PREFIXES if len(word) > n]


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def value(feature: str, times: int) -> float:
    return log1p(times) if feature == ANY else 1.0


class OrdinalModel:
    """Feature weights and two ordered thresholds."""

    def __init__(self, features: dict[str, float], thresholds: tuple[float, float]):
        self.features, self.thresholds = features, thresholds
        self.plain = {f for f in features if f[-1] not in "-*"}
        cut = {n: {f[:-1] for f in features if f[-1] == "-" and len(f) == n + 1} for n in PREFIXES}
        self.cut = {n: known for n, known in cut.items() if known}

    def hits(self, text: str | None) -> dict[str, int]:
        """Occurrences in the text of each known feature, and of all known words."""
        found: dict[str, int] = {}
        every = words(text)
        for w in set(every):
            own = [w] if w in self.plain else []
            for n, known in self.cut.items():
                if w[:n] in known and len(w) > n:
                    own.append(w[:n] + "-")
            if own:
                times = every.count(w)
                for f in (*own, ANY):
                    found[f] = found.get(f, 0) + times
        return found

    def severity(self, text: str | None) -> float:
        z = sum(self.features[f] * value(f, n) for f, n in sorted(self.hits(text).items()))
        return float(sum(1 / (1 + np.exp(np.clip(t - z, -50, 50))) for t in self.thresholds))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, l2: float = L2, steps: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the cumulative-link model by full
    gradient steps (Adam); threshold 2 = threshold 1 + exp(gap)."""
    # equal rows (most clean texts hold no feature) count once, with their number
    rows, share = np.unique(np.column_stack([x, grade]), axis=0, return_counts=True)
    x, grade, share = rows[:, :-1], rows[:, -1], share / share.sum()
    w, t, gap = np.zeros(x.shape[1]), 1.0, 0.0
    m = np.zeros(x.shape[1] + 2)
    v = np.zeros_like(m)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    for step in range(1, steps + 1):
        z = x @ w
        c1, c2 = sigmoid(t - z), sigmoid(t + np.exp(gap) - z)
        p = np.select([grade == 0, grade == 1], [c1, c2 - c1], 1 - c2).clip(1e-9)
        d1 = np.select([grade == 0, grade == 1], [1.0, -1.0], 0.0) / p * c1 * (1 - c1) * share
        d2 = np.select([grade == 1, grade == 2], [1.0, -1.0], 0.0) / p * c2 * (1 - c2) * share
        up = np.concatenate([-(x.T @ (d1 + d2)) - l2 * w, [(d1 + d2).sum(), (d2 * np.exp(gap)).sum()]])
        m, v = 0.9 * m + 0.1 * up, 0.999 * v + 0.001 * up * up
        move = 0.2 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, t, gap = np.maximum(0, w + move[:-2]), t + move[-2], gap + move[-1]
    return w, np.array([t, t + np.exp(gap)])


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS,
        max_features: int = MAX_FEATURES) -> OrdinalModel | None:
    """Fit on a bounded sample of ``labels`` (doc_id, toxic) found in ``docs``
    (doc_id, text). None if there is no labelled toxic or no clean document.
    A doc_id labelled twice counts as toxic if any of its labels is."""
    marked = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    order = F.xxhash64("doc_id", F.lit("toxicity sample"))
    sample = None
    for wanted, limit in ((1, toxic_rows), (0, clean_rows)):
        part = marked.where(F.col("toxic") == wanted).orderBy(order, "doc_id").limit(limit)
        sample = part if sample is None else sample.unionByName(part)
    # at most toxic_rows + clean_rows ids: a proven bound
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").where("text is not null")

    def distinct_features():
        def compute(texts):
            return [pa.array([sorted({f for w in set(words(t)) for f in word_features(w)}) for t in texts],
                             pa.list_(pa.string()))]

        return compute

    listed = annotate(rows, "text", StructType([StructField("features", ArrayType(StringType()))]), distinct_features,
                      ["toxic"])
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return None
    lift = ((F.col("a") + 0.5) / (n_toxic + 1)) / ((F.col("b") + 0.5) / (n_clean + 1))
    found = (listed.select("toxic", F.explode("features").alias("feature")).groupBy("feature")
             .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
             .where((F.col("a") >= max(min(MIN_TOXIC_ROWS, n_toxic), MIN_TOXIC_SHARE * n_toxic))
                    & (lift >= min(MIN_LIFT, n_toxic / 2 + 1)))
             .orderBy(F.desc(F.log(lift) * F.sqrt("a")), "feature").limit(max_features).collect())
    counts = {r["feature"]: (r["a"], r["b"]) for r in found}
    # a prefix as frequent as a longer form of itself adds nothing
    chosen = [f for f, n in counts.items()
              if f[-1] != "-" or not any(m == n and g != f and g.startswith(f[:-1]) for g, m in counts.items())]
    chosen.append(ANY)
    column = {f: i for i, f in enumerate(chosen)}
    probe = OrdinalModel(dict.fromkeys(chosen, 0.0), (0.0, 0.0))

    def sparse():
        def compute(texts):
            hits = [probe.hits(t) for t in texts]
            return [pa.array([[column[f] for f in h] for h in hits], pa.list_(pa.int64())),
                    pa.array([list(h.values()) for h in hits], pa.list_(pa.int64())),
                    pa.array([len(words(t)) for t in texts], pa.int64())]

        return compute

    fields = StructType([StructField("at", ArrayType(LongType())), StructField("n", ArrayType(LongType())),
                         StructField("length", LongType())])
    data = annotate(rows, "text", fields, sparse, ["doc_id", "toxic"]).orderBy("doc_id").collect()
    x = np.zeros((len(data), len(chosen)))
    for i, r in enumerate(data):
        x[i, r["at"]] = [value(chosen[f], n) for f, n in zip(r["at"], r["n"])]
    toxic = np.array([r["toxic"] for r in data])
    density = np.array([max(r["n"], default=0) / max(1, r["length"]) for r in data])
    grade = toxic + (toxic * (density > np.median(density[toxic == 1])))
    w, thresholds = fit_ordinal(x, grade)
    return OrdinalModel(dict(zip(chosen, w.tolist())), tuple(thresholds.tolist()))


def predict(docs: DataFrame, model: OrdinalModel | None, keep=("doc_id",), text: str = "text",
            name: str = "severity") -> DataFrame:
    """``keep`` columns and the expected severity (0 to 2); 0 for null and
    empty texts, and for all texts if there was nothing to learn from."""

    def make():
        def compute(texts):
            return [pa.array([model.severity(t) if model and t else 0.0 for t in texts], pa.float64())]

        return compute

    return annotate(docs, text, StructType([StructField(name, DoubleType())]), make, keep)


def grade_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, severity, grade (severity rounded half up, 0 to
    2), toxic (severity >= REJECT_SEVERITY). A null text is an empty one. Repeated
    rows stay repeated; texts of any length are read whole; other columns are not
    read; an empty table gives none."""
    out = predict(docs, fit(docs, labels))
    return out.select("doc_id", "severity", F.floor(F.col("severity") + 0.5).alias("grade"),
                      (F.col("severity") >= REJECT_SEVERITY).alias("toxic"))


def keep_civil(docs: DataFrame, labels: DataFrame, reject: float = REJECT_SEVERITY) -> DataFrame:
    """Rows of ``docs`` whose expected severity is below ``reject``."""
    name = "keepwise_severity"
    return predict(docs, fit(docs, labels), docs.columns, name=name).where(F.col(name) < reject).drop(name)
