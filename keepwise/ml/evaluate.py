"""Classifier evaluation on any ``(label, probability)`` DataFrame
(M8 .. M11, M13).

Every metric is an aggregation, so it runs where the scores are. AUC and the
ROC curve come from the counts per distinct score and their running sums, taken
over a fixed grid of score ranges; scores are not rounded. Counts stay exact
until the final division, which keeps results independent of partitioning.
Nothing runs before the result is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X


def predicted(prob: Column, threshold: float = 0.5) -> Column:
    return (prob >= F.lit(float(threshold))).cast("int")


def confusion_counts(df: DataFrame, label: str = "label", probability: str = "probability",
                     threshold: float = 0.5, prediction: str | None = None) -> DataFrame:
    """One row: tn, fp, fn, tp (bigint)."""
    y = F.col(label) == 1
    p = (F.col(prediction) == 1) if prediction else (predicted(F.col(probability), threshold) == 1)
    return df.agg(
        X.count_when(~y & ~p).alias("tn"), X.count_when(~y & p).alias("fp"),
        X.count_when(y & ~p).alias("fn"), X.count_when(y & p).alias("tp"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", probability: str = "probability",
                     threshold: float = 0.5, prediction: str | None = None) -> DataFrame:
    """Four rows (label, prediction, count), zero cells included."""
    c = confusion_counts(df, label, probability, threshold, prediction)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(n).alias("count"))
        for a, b, n in cells])).alias("r")).select("r.*")


def accuracy(df: DataFrame, label: str = "label", probability: str = "probability",
             threshold: float = 0.5, prediction: str | None = None) -> DataFrame:
    """M8: share of rows whose predicted class equals the label."""
    p = F.col(prediction) if prediction else predicted(F.col(probability), threshold)
    hit = X.count_when(p == F.col(label))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n"), hit.alias("correct")).select(
        "n", "correct", X.safe_ratio(F.col("correct"), F.col("n")).alias("accuracy"))


def _div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) > 0, (F.lit(2.0) * p * r) / (p + r)).otherwise(F.lit(0.0))


def classification_report(df: DataFrame, label: str = "label", probability: str = "probability",
                          threshold: float = 0.5, prediction: str | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and
    support-weighted averages (zero where a denominator is zero), and the
    accuracy line (its value in ``f1_score``, as the printed report shows it)."""
    c = confusion_counts(df, label, probability, threshold, prediction)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    s0, s1 = tn + fp, tp + fn
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    m = c.select(p0.alias("p0"), r0.alias("r0"), p1.alias("p1"), r1.alias("r1"),
                 s0.alias("s0"), s1.alias("s1"), "tn", "tp")
    m = m.withColumn("f0", _f1(F.col("p0"), F.col("r0"))).withColumn("f1", _f1(F.col("p1"), F.col("r1")))
    tot = (F.col("s0") + F.col("s1")).cast("double")

    def wavg(a: str, b: str) -> Column:
        return F.when(tot > 0, (F.col(a) * F.col("s0").cast("double") + F.col(b) * F.col("s1").cast("double"))
                      / tot).otherwise(F.lit(0.0))

    acc = F.when(tot > 0, (F.col("tn") + F.col("tp")).cast("double") / tot)
    none = F.lit(None).cast("double")
    rows = [
        ("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        ("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        ("macro avg", (F.col("p0") + F.col("p1")) / 2.0, (F.col("r0") + F.col("r1")) / 2.0,
         (F.col("f0") + F.col("f1")) / 2.0, F.col("s0") + F.col("s1")),
        ("weighted avg", wavg("p0", "p1"), wavg("r0", "r1"), wavg("f0", "f1"), F.col("s0") + F.col("s1")),
        ("accuracy", none, none, acc, F.col("s0") + F.col("s1")),
    ]
    return m.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"),
                 s.cast("long").alias("support"))
        for n, p, r, f, s in rows])).alias("r")).select("r.*")


def score_counts(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """(score, pos, neg): rows per distinct score and class."""
    y = F.col(label) == 1
    return df.groupBy(F.col(probability).cast("double").alias("score")).agg(
        X.count_when(y).alias("pos"), X.count_when(~y).alias("neg"))


#: Ranges of the unit interval over which running sums are carried.
GRID = 65_536


def running_counts(counts: DataFrame) -> DataFrame:
    """``score_counts`` with, per score, the rows of lower scores
    (``pos_below``, ``neg_below``), the counts of the next lower score
    (``pos_next``, ``neg_next``; null for the lowest) and all rows (``P``, ``N``).

    Scores fall into ``GRID`` ranges (beyond 0 and 1 into the outer ones, null
    below all); windows run inside a range, and over the at most ``GRID`` + 2
    rows that sum up the ranges, which are joined back."""
    score = F.col("score")
    cell = F.when(score.isNull(), -1).otherwise(F.floor(F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0)) * GRID).cast("int"))
    rows = counts.withColumn("cell", cell)
    order = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    top = F.max_by(F.struct("pos", "neg"), F.coalesce(score, F.lit(float("-inf"))))
    cells = rows.groupBy("cell").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), top.alias("top"))
    cells = cells.select(
        F.col("cell").alias("c"), F.coalesce(F.sum("p").over(order), F.lit(0)).alias("p0"),
        F.coalesce(F.sum("n").over(order), F.lit(0)).alias("n0"), F.lag("top").over(Window.orderBy("cell")).alias("low"),
        F.sum("p").over(Window.partitionBy(F.lit(0))).alias("P"), F.sum("n").over(Window.partitionBy(F.lit(0))).alias("N"))
    inside = Window.partitionBy("cell").orderBy(score.asc_nulls_first())
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.lag(F.struct("pos", "neg")).over(inside), F.col("low"))
    # bounded by GRID + 2 rows
    return rows.join(F.broadcast(cells), F.col("cell") == F.col("c")).select(
        "score", "pos", "neg", (F.coalesce(F.sum("pos").over(before), F.lit(0)) + F.col("p0")).alias("pos_below"),
        (F.coalesce(F.sum("neg").over(before), F.lit(0)) + F.col("n0")).alias("neg_below"),
        lower["pos"].alias("pos_next"), lower["neg"].alias("neg_next"), "P", "N")


def roc_auc(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """M9: exact Mann-Whitney AUC over the distinct scores (ties count one
    half): sum(pos * (2 * neg_below + neg_tied)) / (2 * P * N). Products are
    decimals, so neither the number of scores nor of rows is limited."""
    h = running_counts(score_counts(df, label, probability))
    pair = F.col("pos").cast("decimal(18,0)") * (F.lit(2) * F.col("neg_below") + F.col("neg")).cast("decimal(20,0)")
    t = h.agg(F.sum(pair).alias("u2"), F.sum("pos").cast("long").alias("positives"),
              F.sum("neg").cast("long").alias("negatives"))
    den = F.lit(2.0) * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return t.select("positives", "negatives",
                    F.when(den > 0, F.col("u2").cast("double") / den).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", probability: str = "probability",
              drop_intermediate: bool = False) -> DataFrame:
    """The curve's points from the highest threshold down: first
    (threshold +inf, fpr 0, tpr 0), then one point per distinct score with rows
    scoring >= threshold predicted positive.

    ``drop_intermediate`` leaves out the points the curve runs straight through
    with equal steps on both sides, as the reference's plot does: a point goes
    if the next lower score adds the same counts as its own. The first and the
    last score always stay; the area does not change."""
    h = running_counts(score_counts(df, label, probability))
    highest = (F.col("pos_below") + F.col("pos") == F.col("P")) & (F.col("neg_below") + F.col("neg") == F.col("N"))
    if drop_intermediate:
        straight = (F.col("pos") == F.col("pos_next")) & (F.col("neg") == F.col("neg_next"))
        h = h.where(highest | F.col("pos_next").isNull() | ~straight)
    point = F.struct(
        F.col("score").alias("threshold"), _div(F.col("N") - F.col("neg_below"), F.col("N")).alias("fpr"),
        _div(F.col("P") - F.col("pos_below"), F.col("P")).alias("tpr"))
    start = F.struct(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    # nothing is above the highest score: it also emits the starting point
    pts = F.when(highest, F.array(start, point)).otherwise(F.array(point))
    return h.select(F.explode(pts).alias("p")).select("p.*")

