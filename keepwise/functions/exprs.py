"""Column-level business expressions (P5 .. P11, A7, A8)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C


def flag(cond: Column) -> Column:
    """P5: ``CASE WHEN cond THEN 1 ELSE 0 END`` (NULL condition gives 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def churn_label(status: Column) -> Column:
    return flag(status == F.lit(C.STATUS_CHURNED))


def lifecycle_stage(tenure_days: Column) -> Column:
    """New < 90 days, Growing < 365 days, else Established."""
    return (
        F.when(tenure_days < C.NEW_MAX_DAYS, F.lit(C.STAGE_NEW))
        .when(tenure_days < C.GROWING_MAX_DAYS, F.lit(C.STAGE_GROWING))
        .otherwise(F.lit(C.STAGE_ESTABLISHED))
    )


def risk_tier(probability: Column, high: float = C.HIGH_RISK_THRESHOLD,
              medium: float = C.MEDIUM_RISK_THRESHOLD) -> Column:
    """Tier decided on the unrounded probability (0.69995 is Medium)."""
    return (
        F.when(probability >= F.lit(high), F.lit(C.HIGH_RISK))
        .when(probability >= F.lit(medium), F.lit(C.MEDIUM_RISK))
        .otherwise(F.lit(C.LOW_RISK))
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``CASE WHEN den > 0 THEN CAST(num AS FLOAT) / den ELSE 0 END``.

    The guard also keeps ANSI mode from raising on a zero denominator.
    """
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double")).otherwise(
        F.lit(0.0)
    )


def relative_change(recent: Column, previous: Column) -> Column:
    """``(recent - previous) / previous``; 0 when previous is missing or
    not positive, NULL when only ``recent`` is missing."""
    r = recent.cast("double")
    p = previous.cast("double")
    return F.when(p > 0, (r - p) / p).otherwise(F.lit(0.0))


def hash32(text: Column) -> Column:
    """First 8 hex digits of md5(text) as a non-negative integer: a bucket
    number for splits and folds, not an identifier."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def coalesce_zero(c: Column) -> Column:
    """P10: ``COALESCE(c, 0)``."""
    return F.coalesce(c, F.lit(0))


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` as a bigint."""
    return F.sum(flag(cond)).cast("long")


def exact_mean(value: Column) -> Column:
    """A5: NULL-skipping mean as ``CAST(SUM(x) AS DOUBLE) / COUNT(x)``.

    Summing decimals is exact in any order, so the mean is bit-identical on
    every partitioning and in any SQL engine that sums exactly.
    """
    n = F.count(value)
    return F.when(n > 0, F.sum(value).cast("double") / n.cast("double"))


def mean_when(cond: Column, value: Column) -> Column:
    """``AVG(CASE WHEN cond THEN value END)`` - only matching rows count."""
    return exact_mean(F.when(cond, value))


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def fill_numeric_nulls(df: DataFrame, value: int = 0, exclude: Iterable[str] = ()) -> DataFrame:
    """Fill NULL with ``value`` in numeric columns only; dates and strings
    keep their NULLs (the pandas ``select_dtypes(number).fillna(0)`` rule)."""
    skip = set(exclude)
    cols = [c for c in numeric_columns(df) if c not in skip]
    return df.na.fill(value, subset=cols) if cols else df


def select_excluding(df: DataFrame, exclude: Sequence[str] = C.EXCLUDED_FEATURE_COLUMNS) -> DataFrame:
    """Keep every column not on the exclusion list, in input order."""
    drop = set(exclude)
    return df.select([c for c in df.columns if c not in drop])
