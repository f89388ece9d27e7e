"""Rolling windows kept as daily partial states.

The six- and twelve-month windows move by one day per run, while a full
recomputation reads all their raw rows again. Here every day of activity and
invoices is reduced once to partial aggregates, kept by day:

* ``usage_days``: one row per customer and day with the counts and exact sums
  that add up over days, and the last login;
* ``usage_values``: the day's distinct (customer, session) and (customer,
  feature) pairs. Distinct counts do not add up, but the pairs of all days of a
  window do, whichever days leave or enter it;
* ``invoice_days``: the same for invoices.

``advance`` reads the raw rows of the days it is given and nothing else, so
tomorrow's clock costs one day of raw rows; the evaluations read only partials,
pruned to the window's days, and give exactly what the full recomputation gives.
A day is replaced as a whole: repeating a day, or running it again when late
rows have come, leaves the same state as one run over all rows.

Windows must begin and end at midnight, so the clock must be a midnight.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import dates
from ..functions import exprs as X
from .features import CORE, FULL, _check, as_datetime, financial_columns, usage_columns

SESSION, FEATURE = "session", "feature"


def _midnight(clock) -> dt.datetime:
    at = as_datetime(clock)
    if at.time() != dt.time():
        raise ValueError(f"daily states end at midnight, not at {at}")
    return at


def usage_days(activity: DataFrame) -> DataFrame:
    """Partial aggregates of activity per customer and day."""
    duration = F.col("session_duration_minutes")
    return activity.groupBy("customer_id", F.to_date("login_date").alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(duration).alias("duration_sum"), F.count(duration).alias("duration_n"),
        F.max("login_date").alias("last_login"),
        X.count_when(F.col("event_type") == C.EVENT_FEATURE_ADOPTION).alias("adoptions"),
        F.sum("api_calls").cast("long").alias("api_calls"))


def usage_values(activity: DataFrame) -> DataFrame:
    """Distinct sessions and features per customer and day, in one pass."""
    pairs = F.explode(F.array(F.struct(F.lit(SESSION).alias("kind"), F.col("session_id").cast("string").alias("value")),
                              F.struct(F.lit(FEATURE).alias("kind"), F.col("feature_id").cast("string").alias("value"))))
    return (activity.select("customer_id", F.to_date("login_date").alias("day"), pairs.alias("p"))
            .select("customer_id", "day", "p.kind", "p.value").where("value is not null").distinct())


def invoice_days(invoices: DataFrame) -> DataFrame:
    """Partial aggregates of invoices per customer and day."""
    status = F.col("payment_status")
    return invoices.groupBy("customer_id", F.to_date("invoice_date").alias("day")).agg(
        F.count(F.lit(1)).alias("invoices"), F.sum("amount").alias("amount_sum"), F.count("amount").alias("amount_n"),
        F.max("invoice_date").alias("last_invoice"), X.count_when(status == C.PAYMENT_LATE).alias("late"),
        X.count_when(status == C.PAYMENT_FAILED).alias("failed"), X.count_when(status == C.PAYMENT_PAID).alias("paid"))


def _write_days(partials: DataFrame, path: str, first: dt.datetime, last: dt.datetime) -> None:
    """Replace the days [first, last) under ``path``. Every day gets a marker
    row (``is_day``), so a day that has lost all its rows is replaced too.
    Large days are written by several tasks (rebalanced, not hashed by day)."""
    days = (last - first).days
    marks = partials.sparkSession.range(days).select(
        F.date_add(F.lit(first.date()), F.col("id").cast("int")).alias("day"), F.lit(True).alias("is_day"))
    out = partials.withColumn("is_day", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    (out.hint("rebalance", "day").write.partitionBy("day").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def advance(path: str, first, last, activity: DataFrame | None = None, invoices: DataFrame | None = None) -> None:
    """Reduce the raw rows of the days [first, last) into the state under
    ``path``; days written before are replaced. Both ends are midnights."""
    first, last = _midnight(first), _midnight(last)
    span = dates.as_of_literal(first), dates.as_of_literal(last)
    if activity is not None:
        day = activity.where(dates.in_window(F.col("login_date"), *span))
        _write_days(usage_days(day), f"{path}/usage_days", first, last)
        _write_days(usage_values(day), f"{path}/usage_values", first, last)
    if invoices is not None:
        _write_days(invoice_days(invoices.where(dates.in_window(F.col("invoice_date"), *span))),
                    f"{path}/invoice_days", first, last)


def _read_days(spark: SparkSession, path: str, lower: Column, clock: Column) -> DataFrame:
    """Partials of the days [lower, clock); the bounds prune whole days."""
    df = spark.read.parquet(path)
    return df.where(~F.col("is_day") & (F.col("day") >= F.to_date(lower)) & (F.col("day") < F.to_date(clock))).drop("is_day")


def _mean(total: str, n: str, cond: Column | None = None) -> Column:
    """Exact mean from partial sums and counts, over the days that fulfil ``cond``."""
    pick = (lambda c: F.when(cond, F.col(c))) if cond is not None else F.col
    count = F.coalesce(F.sum(pick(n)), F.lit(0))
    return F.when(count > 0, F.sum(pick(total)).cast("double") / count.cast("double"))


def _distinct_counts(values: DataFrame) -> DataFrame:
    """Sessions and features per customer over all days: pairs are reduced to
    distinct ones before customers are counted, so one busy customer is spread."""
    pairs = values.groupBy("customer_id", "kind", "value").agg(F.lit(1).alias("one"))
    return pairs.groupBy(F.col("customer_id").alias("v_id")).agg(
        F.count_if(F.col("kind") == SESSION).alias("sessions"), F.count_if(F.col("kind") == FEATURE).alias("features"))


def _per_customer(spark: SparkSession, path: str, as_of, aggs: list[Column]) -> DataFrame:
    clock = dates.as_of_literal(_midnight(as_of))
    lower = dates.months_before(as_of, C.USAGE_MONTHS)
    days = _read_days(spark, f"{path}/usage_days", lower, clock).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("active_days"), F.max("last_login").alias("last_login_date"),
        _mean("duration_sum", "duration_n").alias("avg_session_duration"), *aggs)
    counts = _distinct_counts(_read_days(spark, f"{path}/usage_values", lower, clock))
    return days.join(counts, F.col("customer_id").eqNullSafe(F.col("v_id")), "left").drop("v_id")


def rolling_usage(spark: SparkSession, path: str, as_of, profile: str = FULL) -> DataFrame:
    """Q2 at the clock from the daily states: the columns of ``usage_metrics``."""
    _check(profile)
    aggs = [F.sum("adoptions").alias("feature_adoptions")]
    if profile == FULL:
        recent = F.to_date(dates.months_before(as_of, C.USAGE_RECENT_MONTHS))
        previous = F.to_date(F.greatest(
            dates.nested_months_before(as_of, C.USAGE_RECENT_MONTHS, C.USAGE_PREVIOUS_MONTHS),
            dates.months_before(as_of, C.USAGE_TREND_PREFILTER_MONTHS)))
        day = F.col("day")
        aggs += [F.sum("api_calls").alias("total_api_calls"),
                 _mean("duration_sum", "duration_n", day >= recent).alias("recent_avg_session"),
                 _mean("duration_sum", "duration_n", (day >= previous) & (day < recent)).alias("previous_avg_session")]
    g = _per_customer(spark, path, as_of, aggs).withColumnsRenamed(
        {"sessions": "total_sessions", "features": "unique_features_used"})
    return usage_columns(g, dates.as_of_literal(as_of), profile)


def rolling_rollup(spark: SparkSession, path: str, as_of) -> DataFrame:
    """R6 at the clock from the daily states: the columns of ``activity_rollup``."""
    g = _per_customer(spark, path, as_of, [])
    return g.select("customer_id", dates.day_diff(F.col("last_login_date"), dates.as_of_literal(as_of)).alias("days_since_login"),
                    X.coalesce_zero(F.col("features")).alias("features_used"), F.col("avg_session_duration").alias("avg_session_time"))


def rolling_financial(spark: SparkSession, path: str, as_of, profile: str = FULL) -> DataFrame:
    """Q3 at the clock from the daily states: the columns of ``financial_metrics``."""
    _check(profile)
    clock = dates.as_of_literal(_midnight(as_of))
    rows = _read_days(spark, f"{path}/invoice_days", dates.months_before(as_of, C.FINANCIAL_MONTHS), clock)
    aggs = [F.sum("amount_sum").alias("_revenue"), _mean("amount_sum", "amount_n").alias("avg_monthly_revenue"),
            F.sum("invoices").alias("total_invoices"), F.max("last_invoice").alias("last_invoice_date"),
            F.sum("late").alias("late_payments"), F.sum("failed").alias("failed_payments"),
            F.sum("paid").alias("successful_payments")]
    if profile == FULL:
        recent = F.to_date(dates.months_before(as_of, C.REVENUE_RECENT_MONTHS))
        previous = F.to_date(F.greatest(
            dates.nested_months_before(as_of, C.REVENUE_RECENT_MONTHS, C.REVENUE_PREVIOUS_MONTHS),
            dates.months_before(as_of, C.REVENUE_TREND_PREFILTER_MONTHS)))
        day = F.col("day")
        aggs += [_mean("amount_sum", "amount_n", day >= recent).alias("recent_mrr"),
                 _mean("amount_sum", "amount_n", (day >= previous) & (day < recent)).alias("previous_mrr")]
    return financial_columns(rows.groupBy("customer_id").agg(*aggs), clock, profile)


__all__ = ["CORE", "FULL", "advance", "rolling_financial", "rolling_rollup", "rolling_usage"]
