"""Training-table preparation: split, class weights, scaler statistics,
class balance (M2 .. M4, A12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.reports import attach_scalar

TRAIN = "train"
TEST = "test"


def split_bucket(id_col: Column, seed: int) -> Column:
    """32-bit bucket of ``md5(id || ':' || seed)``; same on any partitioning."""
    return X.hash32(F.concat(id_col.cast("string"), F.lit(f":{int(seed)}")))


def hash_split(df: DataFrame, id_col: str = "customer_id", fraction: float = 0.2, seed: int = 42,
               split_col: str = "split") -> DataFrame:
    """M2: mark about ``fraction`` of the rows 'test', the rest 'train'.

    A row's side depends only on its id and the seed: no sort, no shuffle,
    repeatable across runs and cluster sizes. Stratified in expectation (the
    hash is independent of the label), not exactly."""
    cut = F.lit(float(fraction) * 4294967296.0)
    return df.withColumn(split_col, F.when(split_bucket(F.col(id_col), seed) < cut, F.lit(TEST))
                         .otherwise(F.lit(TRAIN)))


def class_weights(df: DataFrame, label: str = "churned") -> DataFrame:
    """M4: balanced weight per class, n / (k * n_c), in one pass: totals come
    from the per-class rows (the window runs over one row per class)."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    classes = Window.partitionBy(F.lit(1))
    total, k = F.sum("n").over(classes), F.count(label).over(classes)
    return per.select(F.col(label), F.col("n"),
                      (total.cast("double") / (k.cast("double") * F.col("n").cast("double"))).alias("weight"))


def add_class_weight(df: DataFrame, label: str = "churned", weight_col: str = "class_weight") -> DataFrame:
    """Attach the balanced weight of each row's class."""
    w = class_weights(df, label).select(F.col(label), F.col("weight").alias(weight_col))
    return df.join(w, label, "left")


def split_class_balance(df: DataFrame, label: str = "churned", split_col: str = "split") -> DataFrame:
    """Rows, positives and positive rate per split."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(label)).cast("long").alias("positives"),
        X.exact_mean(F.col(label)).alias("positive_rate"),
    )


def scaler_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M3: mean and sample standard deviation per column, the moments a
    ``StandardScaler(withMean=True, withStd=True)`` fitted on ``df`` holds, as
    counts, means and centred squares that partitions merge. Values are neither
    rounded nor squared uncentred: a first pass gives a centre per column, the
    second takes the moments of the differences, so ratios, and values of any size
    with a small spread, keep their digits. One row per column; a single row has
    no deviation."""
    first = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"{c}__at") for c in cols])
    near = attach_scalar(df.select(*cols), first)
    moved = {c: F.col(c).cast("double") - F.col(f"{c}__at") for c in cols}
    wide = near.agg(*[a for c in cols for a in ((F.first(f"{c}__at") + F.avg(moved[c])).alias(f"{c}__mean"),
                                                F.stddev_samp(moved[c]).alias(f"{c}__std"))])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
        for c in cols])).alias("r")).select("r.*")
