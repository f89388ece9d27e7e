"""Prediction rows, latest prediction per customer, referential check
(Q7, W1, J6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates
from ..functions import exprs as X

PREDICTION_COLUMNS = ("prediction_id", "customer_id", "prediction_date", "churn_probability",
                      "risk_tier", "model_version", "created_at")


def prediction_key(customer_id: Column, prediction_date: Column, model_version: Column) -> Column:
    """Repeatable 128-bit id (hex digest) of (customer, date, version).

    Replaces the reference's IDENTITY counter, which would need one global
    sequence; any task can compute this one, and re-running a day yields the
    same ids (so an append can be de-duplicated). The whole digest is kept:
    a shorter one would collide among billions of predictions."""
    return F.md5(F.concat_ws("|", customer_id.cast("string"), prediction_date.cast("string"), model_version))


def prediction_rows(scored: DataFrame, as_of=None, model_version: str = C.DEFAULT_MODEL_VERSION,
                    probability_col: str = "churn_probability",
                    prediction_date: Column | None = None, created_at=None,
                    high: float = C.HIGH_RISK_THRESHOLD,
                    medium: float = C.MEDIUM_RISK_THRESHOLD) -> DataFrame:
    """Q7: probability -> tier -> stored row.

    The tier is decided on the unrounded probability and only then is the
    probability stored as DECIMAL(5,4), so 0.69995 is stored as 0.7000 and is
    still 'Medium Risk' (the reference's INSERT does the same). ``created_at``
    is the time of the insert unless given."""
    clock = dates.as_of_literal(as_of)
    p = F.col(probability_col).cast("double")
    day = prediction_date if prediction_date is not None else F.to_date(clock)
    version = F.lit(model_version)
    return scored.select(
        prediction_key(F.col("customer_id"), day, version).alias("prediction_id"),
        F.col("customer_id").cast("long").alias("customer_id"),
        day.alias("prediction_date"),
        p.cast("decimal(5,4)").alias("churn_probability"),
        X.risk_tier(p, high, medium).alias("risk_tier"),
        version.alias("model_version"),
        dates.as_of_literal(created_at).alias("created_at"),
    )


def latest_prediction(predictions: DataFrame, key: str = "customer_id",
                      order: Sequence[str] = ("prediction_date", "created_at", "prediction_id"),
                      as_of=None) -> DataFrame:
    """Each customer's most recent prediction: the latest date, of one day
    the last written, then the higher id (the reference leaves ties open).
    With ``as_of`` only predictions dated up to that day count.

    Expressed as a ``max_by`` aggregation instead of ``ROW_NUMBER() = 1``:
    it partially aggregates on the map side, so a customer scored millions of
    times still ships one row per map task, never its whole history."""
    if as_of is not None:
        predictions = predictions.where(F.col("prediction_date") <= F.to_date(dates.as_of_literal(as_of)))
    payload = [c for c in predictions.columns if c != key]
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), F.struct(*[F.col(c) for c in order]))
    return (predictions.groupBy(key).agg(best.alias("_latest"))
            .select(F.col(key), *[F.col(f"_latest.{c}").alias(c) for c in payload]))


def orphan_predictions(predictions: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Predictions whose customer is missing (the FOREIGN KEY of the
    reference's table, as a data-quality query)."""
    return predictions.join(customers.select(key), key, "left_anti")
